"""Queries over sentiment, text quality, n-best choice, audits, tagging and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import coding, generate, hypotheses, metrics, prepare, rouge, sentiment as S, tagging
from ..plans import flow
from ..plans.ordering import number_rows
from ..session import cut, scratch_path
from ..streaming import jobs, passes
from . import fixtures as X
from .preparation import CLEAN_SQL, CONCEPT_SQL
from .texts import NAMES, TOKEN_SQL, UPPER_SQL, WORD_SQL, corpus_vectors, sql_list

QUERIES = {}
ORACLE = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return add


LEXICON = [("quality", 1.9), ("toxic", -2.3), ("than", 1.5), ("ther", -1.2), ("the", 0.4),
           ("heit", 2.1), ("keit", -1.7), ("une", 0.8), ("les", -0.6), ("para", 1.1), ("con", -0.9)]
RULES = {"negators": ["no", "nicht", "pas"], "boosters": ["with", "mit", "avec"],
         "dampeners": ["this", "der"], "contrast": ["was"]}


def lexicon(spark):
    return spark.createDataFrame(LEXICON, "word string, valence double")


def sentiment_sql(source: str) -> str:
    """Scores of ``source(k, body)``."""
    values = ", ".join(f"('{w}', {v}::DOUBLE)" for w, v in LEXICON)
    boost = " + ".join(
        f"CASE WHEN v{n} IS NULL AND w{n} IN ({sql_list(RULES['boosters'])}) THEN {0.293 * d}::DOUBLE "
        f"WHEN v{n} IS NULL AND w{n} IN ({sql_list(RULES['dampeners'])}) THEN {-0.293 * d}::DOUBLE ELSE 0 END"
        for n, d in ((1, 1.0), (2, 0.95), (3, 0.9)))
    negate = " * ".join(
        f"CASE WHEN v{n} IS NULL AND w{n} IN ({sql_list(RULES['negators'])}) THEN -0.74::DOUBLE ELSE 1 END"
        for n in (1, 2, 3))
    return f"""
lex AS (SELECT * FROM (VALUES {values}) l(word, valence)),
sdoc AS (SELECT k, regexp_extract_all(body, {WORD_SQL}) AS l,
         length(body) - length(replace(body, '!', '')) AS ex,
         length(body) - length(replace(body, '?', '')) AS qu FROM {source}),
sdoc2 AS (SELECT k, l, len(list_filter(l, lambda t: t = {UPPER_SQL} AND t <> lower(t))) AS up,
          least(ex, 4) * 0.292::DOUBLE + CASE WHEN qu > 3 THEN 0.96 WHEN qu > 1 THEN qu * 0.18 ELSE 0 END::DOUBLE AS marks
          FROM sdoc),
stok AS (SELECT k, up > 0 AND up < len(l) AS mixed, unnest(l) AS t, generate_subscripts(l, 1) AS pos FROM sdoc2),
sjoin AS (SELECT s.*, lower(s.t) AS w, x.valence AS v FROM stok s LEFT JOIN lex x ON x.word = lower(s.t)),
swin AS (SELECT *, lag(w, 1) OVER o AS w1, lag(w, 2) OVER o AS w2, lag(w, 3) OVER o AS w3,
                lag(v, 1) OVER o AS v1, lag(v, 2) OVER o AS v2, lag(v, 3) OVER o AS v3,
                min(CASE WHEN w IN ({sql_list(RULES['contrast'])}) THEN pos END) OVER (PARTITION BY k) AS turn
         FROM sjoin WINDOW o AS (PARTITION BY k ORDER BY pos)),
sloud AS (SELECT *, v + CASE WHEN v < 0 THEN -1 ELSE 1 END
            * CASE WHEN mixed AND t = {UPPER_SQL} AND t <> lower(t) THEN 0.733::DOUBLE ELSE 0 END AS a FROM swin),
sval AS (SELECT k, coalesce((a + CASE WHEN a < 0 THEN -1 ELSE 1 END * ({boost})) * {negate}
            * CASE WHEN pos < turn THEN 0.5 WHEN pos > turn THEN 1.5 ELSE 1 END::DOUBLE, 0) AS x FROM sloud),
ssum AS (SELECT d.k, any_value(d.marks) AS m, coalesce(sum(x), 0) AS s,
                coalesce(sum(CASE WHEN x > 0 THEN x + 1 ELSE 0 END), 0) AS p,
                abs(coalesce(sum(CASE WHEN x < 0 THEN x - 1 ELSE 0 END), 0)) AS n,
                count(CASE WHEN x = 0 THEN 1 END) AS z
         FROM sdoc2 d LEFT JOIN sval USING (k) GROUP BY d.k),
semph AS (SELECT k, z, s + CASE WHEN s = 0 THEN 0 WHEN s < 0 THEN -m ELSE m END AS s,
                 p + CASE WHEN p > n THEN m ELSE 0 END AS p, n + CASE WHEN p < n THEN m ELSE 0 END AS n FROM ssum),
senti AS (SELECT k, CASE WHEN p + n + z = 0 THEN 0 ELSE round(p / (p + n + z) + 1e-9, 3) END AS positive,
                 CASE WHEN p + n + z = 0 THEN 0 ELSE round(n / (p + n + z) + 1e-9, 3) END AS negative,
                 CASE WHEN p + n + z = 0 THEN 0 ELSE round(z / (p + n + z) + 1e-9, 3) END AS neutral,
                 round(s / sqrt(s * s + 15) + 1e-9, 4) + 0.0 AS compound FROM semph)"""


@query(f"""WITH body AS (SELECT doc_id AS k, text AS body FROM documents), {sentiment_sql('body')}
SELECT k AS doc_id, positive, negative, neutral, compound FROM senti""")
def sentiment(spark, sf):
    return S.sentiment(X.table(spark, sf, "documents"), "doc_id", "text", lexicon(spark), **RULES)


@query(f"""WITH ranked AS (
  SELECT c.sno, d.source AS label, c.concept, round(1.0 / (1 + c.sno % 7), 6) AS score
  FROM ({CONCEPT_SQL}) c JOIN documents d ON d.doc_id = c.sno),
body AS (SELECT DISTINCT concept AS k, concept AS body FROM ranked), {sentiment_sql('body')}
SELECT r.sno, r.label AS issue, r.score, s.positive AS sentiment_positive,
       s.negative AS sentiment_negative, s.neutral AS sentiment_neutral, s.compound AS sentiment_compound,
       CASE WHEN concept = 'quality' THEN 1 ELSE 0 END AS quality,
       CASE WHEN concept = 'toxic' THEN 1 ELSE 0 END AS toxic
FROM ranked r JOIN senti s ON s.k = r.concept""")
def binary_coded(spark, sf):
    coded, _ = prepare.prepare_feedback(X.feedback(spark, sf), X.concept_matrix(spark, sf))
    ranked = coded.select("sno", "label", "concept", F.round(
        F.lit(1.0) / (1 + F.col("sno") % 7), 6).alias("score"))
    dictionary = cut(coding.discover(ranked))
    folder = scratch_path(spark, "wide")
    coding.write_wide(coding.sparse_code(ranked, lexicon(spark), dictionary, **RULES), dictionary, folder)
    return coding.read_wide(spark, folder)


def turn_pairs(spark, sf):
    """Each user turn as reference and the assistant turn after it as candidate."""
    turns = X.table(spark, sf, "conversations")
    user = turns.filter("role = 'user'").select(
        "conv_id", F.col("turn"), F.col("text").alias("reference"))
    reply = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("candidate"))
    return user.join(reply, ["conv_id", "turn"]).withColumn(
        "pair", F.concat_ws("/", "conv_id", "turn"))


PAIR_SQL = f"""
pairs AS (SELECT u.conv_id || '/' || u.turn AS pair,
                 regexp_extract_all(lower(u.text), {WORD_SQL}) AS r,
                 regexp_extract_all(lower(a.text), {WORD_SQL}) AS c
          FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
          WHERE u.role = 'user' AND a.role = 'assistant')"""


def _rouge_sql(n: int) -> str:
    gram = lambda c: c if n == 1 else (
        f"list_transform(range(1, len({c})), lambda i: {c}[i] || ' ' || {c}[i + 1])")
    return f"""
g{n} AS (SELECT pair, unnest({gram('r')}) AS g, 1 AS r, 0 AS c FROM pairs
         UNION ALL SELECT pair, unnest({gram('c')}), 0, 1 FROM pairs),
n{n} AS (SELECT pair, g, sum(r) AS r, sum(c) AS c FROM g{n} GROUP BY pair, g),
s{n} AS (SELECT p.pair, coalesce(sum(least(n.r, n.c)), 0)::DOUBLE AS hit,
                coalesce(sum(n.r), 0)::DOUBLE AS r, coalesce(sum(n.c), 0)::DOUBLE AS c
         FROM pairs p LEFT JOIN n{n} n ON n.pair = p.pair GROUP BY p.pair)"""


def _score_sql(metric: str, source: str) -> str:
    return f"""SELECT pair, '{metric}' AS metric,
       round(CASE WHEN r = 0 THEN 0 ELSE hit / r END, 6) AS recall,
       round(CASE WHEN c = 0 THEN 0 ELSE hit / c END, 6) AS precision,
       round(CASE WHEN hit = 0 THEN 0 ELSE 2 * hit / (r + c) END, 6) AS f_score FROM {source}"""


def _rounded(df):
    return df.select("pair", "metric", *[
        F.round(c, 6).alias(c) for c in ("recall", "precision", "f_score")])


@query(f"WITH {PAIR_SQL}, {_rouge_sql(1)}, {_rouge_sql(2)} {_score_sql('1', 's1')} UNION ALL {_score_sql('2', 's2')}")
def rouge_n(spark, sf):
    pairs = turn_pairs(spark, sf)
    return _rounded(rouge.rouge_n(pairs, "pair", 1).withColumn("metric", F.lit("1")).unionByName(
        rouge.rouge_n(pairs, "pair", 2).withColumn("metric", F.lit("2"))))


# Longest common subsequence as a fold: one row of the usual table per reference word.
@query(f"""WITH {PAIR_SQL}, lcs AS (
  SELECT pair, len(r)::DOUBLE AS r, len(c)::DOUBLE AS c,
         list_last(list_reduce(list_transform(r, lambda w: [w]), lambda row, w:
           list_reduce(list_transform(range(1, len(c) + 1), lambda j: [CAST(j AS VARCHAR)]),
             lambda acc, j: list_append(acc, CAST(greatest(
               CAST(row[CAST(j[1] AS BIGINT) + 1] AS BIGINT), CAST(acc[-1] AS BIGINT),
               CASE WHEN c[CAST(j[1] AS BIGINT)] = w[1] THEN CAST(row[CAST(j[1] AS BIGINT)] AS BIGINT) + 1 ELSE 0 END
             ) AS VARCHAR)), ['0']),
           list_transform(range(0, len(c) + 1), lambda z: '0')))::DOUBLE AS hit FROM pairs)
{_score_sql('l', 'lcs')}""")
def rouge_l(spark, sf):
    return _rounded(rouge.rouge_l(turn_pairs(spark, sf), "pair").withColumn("metric", F.lit("l")))


@query()
def rouge_interval(spark, sf):
    return rouge.rouge_interval(rouge.rouge(turn_pairs(spark, sf), "pair"), "pair")


@query(f"""WITH {PAIR_SQL}, {_rouge_sql(1)}, {_rouge_sql(2)}, s AS (
  {_score_sql('1', 's1')} UNION ALL {_score_sql('2', 's2')})
SELECT metric, round(avg(recall), 5) AS recall, round(avg(precision), 5) AS precision,
       round(avg(f_score), 5) AS f_score FROM s GROUP BY metric""")
def rouge_means(spark, sf):
    return rouge.rouge_means(rouge_n(spark, sf)).select("metric", *[
        F.round(c, 5).alias(c) for c in ("recall", "precision", "f_score")])


def n_best(spark, sf):
    docs = X.table(spark, sf, "documents")
    return docs.select(
        F.col("source").alias("example"), F.col("doc_id").alias("hyp"),
        F.size(T.split_space(F.col("text"))).alias("n_tokens"),
        F.col("text").endswith(".").alias("finished"),
        F.array(F.lit(0.0), -F.ln(F.col("n_chars").cast("double"))).alias("log_probs"))


@query("""WITH h AS (
  SELECT source AS example, doc_id AS hyp,
         CAST(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda t: t <> '')) AS INTEGER) AS n_tokens,
         suffix(text, '.') AS finished, -ln(n_chars::DOUBLE) / 2 AS a FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY example ORDER BY finished DESC, a DESC, hyp) AS rn
      FROM h WHERE NOT finished OR n_tokens >= 35)
SELECT example, hyp, n_tokens, finished, round(a, 6) AS avg_log_prob FROM r WHERE rn = 1""")
def best_hypothesis(spark, sf):
    best = hypotheses.pick_best(hypotheses.with_average(n_best(spark, sf)), "example", "hyp", 35)
    return best.select("example", "hyp", "n_tokens", "finished",
                       F.round("avg_log_prob", 6).alias("avg_log_prob"))


@query("""WITH c AS (SELECT source, lang, doc_id, 1.0::DOUBLE / n_chars AS prob FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY prob DESC, doc_id) AS place FROM c)
SELECT source, lang, doc_id, CAST(place AS INTEGER) AS place, round(ln(prob), 6) AS log_prob
FROM r WHERE place <= 8""")
def topk_candidates(spark, sf):
    docs = X.table(spark, sf, "documents").select(
        "source", "lang", "doc_id", (F.lit(1.0) / F.col("n_chars")).alias("prob"))
    top = hypotheses.top_candidates(docs, ["source", "lang"], 4, "doc_id")
    return top.drop("prob").withColumn("log_prob", F.round("log_prob", 6))


@query(f"""WITH b AS (SELECT doc_id, replace(text, chr(10), ' ') AS t FROM documents),
k AS (SELECT doc_id, t, list_filter(list_transform(string_split(regexp_replace(' ' || array_to_string(
        regexp_extract_all(t, {TOKEN_SQL}), ' ') || ' ', ' \\.( )', ' .' || chr(10) || '\\1', 'g'), chr(10)),
        lambda s: trim(s)), lambda s: s <> '') AS s FROM b)
SELECT doc_id, lpad(CAST(doc_id AS VARCHAR), 6, '0') || '_decoded.txt' AS decoded_file,
       'Original Feedback: ' || t || chr(10) || chr(10) || 'Generated Concept: ' || chr(10)
       || coalesce(array_to_string(list_transform(s, lambda x: replace(replace(x, '<', '&lt;'), '>', '&gt;')), ''), '')
         AS decoded FROM k""")
def output_texts(spark, sf):
    docs = X.table(spark, sf, "documents").select(
        "doc_id", T.one_line(F.col("text")).alias("article"),
        F.array("source").alias("reference_sents")).withColumn("words", T.tokens(F.col("article")))
    return hypotheses.output_files(docs, "doc_id").select("doc_id", "decoded_file", "decoded")


def losses(spark, sf):
    return X.table(spark, sf, "events").select(
        F.col("user_id").alias("series"), F.col("event_id").alias("step"),
        F.col("value").alias("loss"))


LOSS_SQL = """
s AS (SELECT user_id AS series, list(event_id ORDER BY event_id) AS steps,
             list(value ORDER BY event_id) AS losses FROM events GROUP BY user_id),
avgs AS (SELECT series, steps, losses, list_reduce(list_transform(losses, lambda x: [x]),
           lambda acc, x: list_append(acc, least(12.0::DOUBLE, CASE WHEN acc[-1] = 0 THEN x[1]
             ELSE acc[-1] * 0.99::DOUBLE + (1 - 0.99::DOUBLE) * x[1] END)), [0.0::DOUBLE]) AS a FROM s),
run AS (SELECT series, unnest(steps) AS step, unnest(losses) AS loss, unnest(a[2:]) AS running_avg FROM avgs)"""


@query(f"WITH {LOSS_SQL} SELECT series, step, loss, round(running_avg, 6) AS running_avg FROM run")
def running_loss(spark, sf):
    return metrics.running_loss(losses(spark, sf), "series", "step", "loss").withColumn(
        "running_avg", F.round("running_avg", 6))


@query(f"""WITH {LOSS_SQL}, r AS (SELECT series, step, round(running_avg, 6) AS x FROM run),
w AS (SELECT *, min(x) OVER (PARTITION BY series ORDER BY step
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM r)
SELECT series, step, x AS running_avg, m IS NULL OR x < m AS is_best FROM w""")
def best_so_far(spark, sf):
    return metrics.best_so_far(running_loss(spark, sf).drop("loss"), "series", "step", "running_avg")


@query("""WITH v AS (SELECT user_id, event_type, CASE WHEN value > 300 THEN 'nan'::DOUBLE ELSE value END AS v FROM events)
SELECT user_id, CASE WHEN bool_and(isfinite(v)) THEN 'finite' WHEN bool_or(isfinite(v)) THEN 'some_nonfinite'
       ELSE 'all_nonfinite' END AS verdict FROM v GROUP BY user_id""")
def finite_audit(spark, sf):
    events = X.table(spark, sf, "events").withColumn(
        "value", F.when(F.col("value") > 300, float("nan")).otherwise(F.col("value")))
    return metrics.finite_audit(events, "user_id", "value")


def attention(spark, sf):
    """Embeddings as attention: example = label, step = place in the label."""
    rows = number_rows(
        X.table(spark, sf, "embeddings").select("label", "vec_id", "embedding"),
        "vec_id", ("label",), "step")
    size = F.transform("embedding", lambda v: F.abs(v.cast("double")))
    total = F.aggregate(size, F.lit(0.0), lambda a, v: a + v)
    return rows.select("label", "step", total.alias("_total"), F.posexplode(size).alias("position", "v")).select(
        "label", "step", "position", (F.col("v") / F.col("_total")).alias("weight"))


ATTENTION_SQL = """
e AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS step,
             list_transform(embedding, lambda v: abs(v::DOUBLE)) AS w FROM embeddings),
att AS (SELECT label, step, unnest(w) / list_sum(w) AS a, generate_subscripts(w, 1) AS p FROM e),
cov AS (SELECT label, step, a, coalesce(sum(a) OVER (PARTITION BY label, p ORDER BY step
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM att),
closs AS (SELECT label, step, sum(least(a, c)) AS covloss FROM cov GROUP BY label, step)"""


@query(f"WITH {ATTENTION_SQL} SELECT label, step, round(covloss, 6) AS covloss FROM closs")
def coverage_audit(spark, sf):
    found = metrics.coverage_losses(attention(spark, sf), "label", "step", "position", "weight")
    return found.withColumn("covloss", F.round("covloss", 6))


@query(f"""WITH {ATTENTION_SQL}, m AS (SELECT label, sum(CASE WHEN step < 40 THEN covloss ELSE 0 END)
   / sum(CASE WHEN step < 40 THEN 1 ELSE 0 END) AS x FROM closs GROUP BY label)
SELECT round(avg(x), 6) AS mean FROM m""")
def masked_mean(spark, sf):
    found = metrics.coverage_losses(attention(spark, sf), "label", "step", "position", "weight")
    masked = found.withColumn("mask", (F.col("step") < 40).cast("int"))
    return metrics.masked_mean(masked, "label", "covloss", "mask").withColumn(
        "mean", F.round("mean", 6))


@query()
def attention_json(spark, sf):
    docs = X.table(spark, sf, "documents").select("doc_id", "text")
    rows = docs.join(X.table(spark, sf, "embeddings").withColumnRenamed("vec_id", "doc_id"), "doc_id", "left")
    weights = F.array_compact(F.array(F.col("embedding").cast("array<double>")))  # empty without an embedding
    return rows.select("doc_id", hypotheses.attention_json(
        F.col("text"), T.words(F.col("text")), F.col("text"), weights).alias("json"))


@query()
def generate_lead(spark, sf):
    return generate.lead_sentences(X.table(spark, sf, "documents"), "doc_id", "text")


@query("""SELECT doc_id, text AS article, replace(upper(text), 'ẞ', 'SS') AS generated FROM documents""")
def generate_plugin(spark, sf):
    docs = X.table(spark, sf, "documents").select("doc_id", F.col("text").alias("article"))
    return generate.generate(docs, lambda articles: articles.str.upper())


@query(f"""WITH d AS (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS v,
                            generate_subscripts(embedding, 1) AS dim FROM embeddings),
m AS (SELECT label, dim, avg(v) AS v FROM d GROUP BY label, dim),
lv AS (SELECT label AS tag, list(v ORDER BY dim) AS vec FROM m GROUP BY label),
s AS (SELECT e.vec_id AS id, l.tag, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), l.vec), 9) AS cs
      FROM embeddings e CROSS JOIN lv l),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cs DESC, tag) AS rn FROM s)
SELECT id, CAST(tag AS BIGINT) AS tag, round(cs, 6) AS score FROM r WHERE rn = 1""")
def label_tag(spark, sf):
    rows = X.table(spark, sf, "embeddings")
    labels = tagging.label_vectors(rows, "label", "embedding")
    feedback = rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return tagging.tag_label(feedback, labels).withColumn("score", F.round("score", 6))


@query()
def concept_report(spark, sf):
    """Documents as generated text, through every stage to ranked concepts."""
    docs = X.table(spark, sf, "documents").select(
        F.col("doc_id").alias("sno"), F.col("source").alias("label"),
        F.col("text").alias("feedback"), F.col("text").alias("generated"))
    params = flow.Parameters(simthreshold=0.8, max_concepts=5, labelmatch=60, minimum_feedbacks=5)
    return flow.important_concepts(docs, corpus_vectors(spark, sf), 64, params, NAMES)


@query(f"""SELECT 'feedback' AS stage, (SELECT count(*) FROM ({CLEAN_SQL})) AS rows
UNION ALL SELECT 'concepts', (SELECT count(*) FROM ({CONCEPT_SQL}))""")
def count_reconcile(spark, sf):
    return prepare.reconcile_counts({
        "feedback": prepare.clean_feedback(X.feedback(spark, sf)),
        "concepts": prepare.concept_rows(X.concept_matrix(spark, sf))})


def _stream(spark, sf, name):
    return jobs.table_stream(spark, f"{sf}/{name}.parquet")


@query(f"""SELECT f.* FROM ({CLEAN_SQL}) f
WHERE NOT EXISTS (SELECT 1 FROM ({CONCEPT_SQL}) c WHERE c.sno = f.sno)""")
def stream_score(spark, sf):
    feedback = _stream(spark, sf, "documents").select(
        F.col("doc_id").alias("sno"), F.col("text").alias("feedback"), F.col("source").alias("label"))
    concepts = prepare.concept_rows(X.concept_matrix(spark, sf))
    return jobs.run_to_table(spark, jobs.score_stream(feedback, concepts), "scored")


@query(f"""WITH {LOSS_SQL}, w AS (SELECT series, step, loss, running_avg, min(running_avg) OVER (
  PARTITION BY series ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM run)
SELECT series, step, loss, round(running_avg, 6) AS running_avg, m IS NULL OR running_avg < m AS is_best,
  false AS late FROM w""")
def stream_running_loss(spark, sf):
    stream = _stream(spark, sf, "events").select(
        F.col("user_id").alias("series"), F.col("event_id").alias("step"), F.col("value").alias("loss"))
    return jobs.losses(spark, stream, "losses", wait=50).withColumn("running_avg", F.round("running_avg", 6))


@query(f"""WITH {X.PARSE_SQL}
SELECT p.range AS pass, doc_id, length(article) AS n_chars FROM record, range(2) p""")
def endless_passes(spark, sf):
    """Two passes of the endless stream, the second one by a restart."""
    records = number_rows(X.records(spark, sf).select("doc_id", F.length("article").cast("long").alias("n_chars")),
                          "doc_id", name="record")
    records = cut(records)
    count, out = records.count(), scratch_path(spark, "passes")
    high, width = passes.grid(count)
    for _ in range(2):
        passes.run_batch(passes.endless_passes(spark, records, count, high * width), out)
    return spark.read.parquet(out).select("pass", "doc_id", "n_chars")


@query("""SELECT d.doc_id, d.source, l.quality FROM documents d JOIN labels l USING (doc_id)""")
def stream_refresh(spark, sf):
    out = scratch_path(spark, "refreshed")
    side_path = f"{sf}/labels.parquet"
    stream = _stream(spark, sf, "documents").select("doc_id", "source")
    use = lambda batch, side: batch.join(side.select("doc_id", "quality"), "doc_id")
    jobs.refreshed_stream(stream, side_path, use, out).awaitTermination()
    schema = use(stream, spark.read.parquet(side_path)).schema
    return spark.read.schema(schema).parquet(out).select("doc_id", "source", "quality")
