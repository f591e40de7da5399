"""The registered queries of these operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut
from . import align, byte_bpe, embed_dedup, line_dedup, mixing, quality, ranked, secrets, simhash, token_count, topk, toxicity, url_filter

BYTE_RANKS = "byte_bpe_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages).select(
        "page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "weight")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_texts(docs, table(spark, sf_dir, "labels")).drop("text")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.count_tokens(docs, public_tokenizers.path(WORD_VOCABULARY)).drop("text")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.encoded_digest(docs, public_tokenizers.path(BYTE_RANKS)).drop("text")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score_texts(docs, table(spark, sf_dir, "labels")).drop("text")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = cut(table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", mixing.word_count(F.col("text")).alias("tokens")))
    return mixing.mix_sources(counted).select("doc_id", "domain", "lang", "source", "epoch", "tokens")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    return align.align(table(spark, sf_dir, "documents").select("doc_id", "text"),
                       path("byte_bpe_50k.json"), path("piece_bpe_32k.model"), ranks=path(BYTE_RANKS))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_toxicity, op3_secrets, op4_simhash, op5_topk_search, op6_embedding_dedup,
    op7_token_count, op8_byte_bpe, op9_quality, op10_mixing, op11_ranked_search, op12_alignment, op13_line_dedup)}

_HOST = (f"translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), "
         f"'{url_filter.UPPER}', '{url_filter.LOWER}')")
_RULED = "\n".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
    f"THEN {{'rule': '{r.host}{r.path}', 'verdict': '{r.verdict}'}}"
    for r in sorted(url_filter.RULES, key=lambda r: -len(r.host + r.path)))
_TERM_ROWS = ", ".join(f"('{t}', {w})" for t, w in url_filter.TERMS.items())
_LOW_URL = f"translate(coalesce(url, ''), '{url_filter.UPPER}', '{url_filter.LOWER}')"

ORACLE: dict[str, str] = {
    "op1_url_filter": f"""
WITH split AS (
  SELECT page_id, {_HOST} AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path, {_LOW_URL} AS low
  FROM pages),
terms(term, w) AS (VALUES {_TERM_ROWS}),
-- a list keeps repeated rows apart; each separator serves two neighbours, so it is doubled
hits AS (
  SELECT *, (SELECT list({{'w': w, 'n': n}}) FROM (
      SELECT w, len(regexp_extract_all(regexp_replace(low, '([^a-z0-9])', '\\1\\1', 'g'),
                                       '(?:^|[^a-z0-9])' || term || '(?:$|[^a-z0-9])')) AS n
      FROM terms) WHERE n > 0) AS found
  FROM split),
ruled AS (
  SELECT *, CASE {_RULED} END AS r,
    coalesce(list_sum(list_transform(found, lambda x: x.w)), 0)::INTEGER AS weight FROM hits)
SELECT page_id, host, path, r.rule AS rule,
  coalesce(r.verdict, CASE WHEN weight >= {url_filter.REJECT} THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(list_sum(list_transform(list_filter(found, lambda x: x.w >= {url_filter.REJECT}), lambda x: x.n)), 0)::INTEGER AS n_strict,
  len(coalesce(list_filter(found, lambda x: x.w < {url_filter.REJECT}), []))::INTEGER AS n_soft, weight
FROM ruled
""",
    "op5_topk_search": """
WITH usable AS (
  SELECT vec_id, row_number() OVER () AS uid,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.uid AS asker, q.vec_id AS query_id, c.vec_id AS vec_id,
         list_inner_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.uid <> c.uid WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY asker ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY asker ORDER BY score DESC, vec_id) <= 5
""",
    "op6_embedding_dedup": """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v)
        / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) >= 0.93),
reached(node, seen) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT reached.node, links.b FROM reached JOIN links ON links.a = reached.seen),
parts AS (SELECT node, min(seen) AS component_id FROM reached GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(counts.n, 0)::BIGINT AS n_links, parts.component_id,
       e.vec_id = parts.component_id AS kept
FROM embeddings e JOIN parts ON parts.node = e.vec_id LEFT JOIN counts ON counts.a = e.vec_id
""",
}

_TERMS = (f"regexp_extract_all(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
ORACLE["op11_ranked_search"] = f"""
WITH doc AS (SELECT row_number() OVER () AS uid, doc_id, {_TERMS} AS t FROM documents),
total AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS terms FROM doc WHERE len(t) > 0),
posting AS (
  SELECT uid, term, count(*)::BIGINT AS tf FROM (SELECT uid, unnest(t) AS term FROM doc) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM posting, total GROUP BY term, docs),
norm AS (SELECT uid, doc_id, 25 + (75 * len(t) * docs) // terms AS m FROM doc, total WHERE len(t) > 0),
item AS (SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS t FROM benchmark),
asked AS (SELECT iid, item_id, term, count(*) AS times FROM (SELECT iid, item_id, unnest(t) AS term FROM item) GROUP BY ALL),
scored AS (
  SELECT iid, item_id, uid, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN posting USING (term) JOIN weight USING (term) JOIN norm USING (uid) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) <= 10
"""
_KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{}', '{}')".format(
    url_filter.UPPER, url_filter.LOWER)
ORACLE["op13_line_dedup"] = f"""
WITH doc AS (
  SELECT row_number() OVER () AS uid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT uid, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM doc),
keyed AS (SELECT *, {_KEY} AS key FROM line),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT uid) >= 10),
kept AS (
  SELECT uid, count(*) FILTER (WHERE gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS text
  FROM (SELECT *, key IN (SELECT key FROM frequent) AS gone FROM keyed) GROUP BY uid)
SELECT doc_id, len(lines)::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(text) AS kept_sha256
FROM doc JOIN kept USING (uid)
"""


def _fill_sql(table: str, family: str, name: str) -> str:
    """DuckDB: share a family's budget by weight up to each member's cap."""
    return f"""
  SELECT *, CASE WHEN is_full THEN cap ELSE CAST(floor(rest_left * weight / rest_weight) AS BIGINT) END AS quota
  FROM (
    SELECT *, arg_min(CASE WHEN NOT is_full THEN left_over END, CASE WHEN NOT is_full THEN place END)
                OVER (PARTITION BY {family}) AS rest_left,
              arg_min(CASE WHEN NOT is_full THEN onward END, CASE WHEN NOT is_full THEN place END)
                OVER (PARTITION BY {family}) AS rest_weight
    FROM (
      SELECT *, cap * onward <= left_over * weight AS is_full FROM (
        SELECT *, greatest(budget - coalesce(sum(cap) OVER (PARTITION BY {family} ORDER BY place
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS left_over,
               sum(weight) OVER (PARTITION BY {family} ORDER BY place
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS onward
        FROM (SELECT *, row_number() OVER (PARTITION BY {family} ORDER BY cap / weight, {name}) AS place
              FROM {table}))))"""


def _weights_sql(name: str, weights: dict[str, int]) -> str:
    return f"CASE {name} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in sorted(weights.items())) + " ELSE 1 END"


ORACLE["op10_mixing"] = f"""
WITH doc AS (
  SELECT doc_id, coalesce(lang, '') AS l, coalesce(source, '') AS s, lang, source,
         'd' || coalesce(TRY_CAST(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS BIGINT), 0) % 4 AS domain,
         len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+'))::BIGINT AS tokens
  FROM documents),
leaf AS (SELECT domain, l, s, sum(tokens)::BIGINT AS total FROM doc GROUP BY ALL),
domain_node AS (
  SELECT 0 AS root, domain, sum(total)::BIGINT * {mixing.MAX_EPOCHS} AS cap,
         {_weights_sql("domain", mixing.DOMAIN_WEIGHTS)} AS weight,
         (SELECT CAST(floor(sum(total) * {mixing.BUDGET_SHARE}) AS BIGINT) FROM leaf) AS budget
  FROM leaf GROUP BY domain),
domain_plan AS ({_fill_sql("domain_node", "root", "domain")}),
lang_node AS (
  SELECT leaf.domain, l, sum(total)::BIGINT * {mixing.MAX_EPOCHS} AS cap,
         {_weights_sql("l", mixing.LANG_WEIGHTS)} AS weight, any_value(p.quota) AS budget
  FROM leaf JOIN domain_plan p ON p.domain = leaf.domain GROUP BY ALL),
lang_plan AS ({_fill_sql("lang_node", "domain", "l")}),
source_node AS (
  SELECT leaf.domain, leaf.l, s, total, total * {mixing.MAX_EPOCHS} AS cap, 1 AS weight, p.quota AS budget
  FROM leaf JOIN lang_plan p ON p.domain = leaf.domain AND p.l = leaf.l),
source_plan AS ({_fill_sql("source_node", "domain, l", "s")}),
read AS (
  SELECT doc.*, e.epoch, p.quota - (e.epoch - 1) * p.total AS quota,
         md5('{mixing.SEED}:' || e.epoch || ':' || coalesce(doc_id::VARCHAR, '')) AS rank
  FROM doc JOIN source_plan p USING (domain, l, s)
  JOIN (SELECT unnest(range(1, {mixing.MAX_EPOCHS} + 1)) AS epoch) e
    ON p.quota > 0 AND e.epoch <= ceil(p.quota / greatest(p.total, 1)))
SELECT doc_id, domain, lang, source, epoch::INTEGER AS epoch, tokens FROM (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, l, s, epoch ORDER BY rank, doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS passed FROM read)
WHERE passed < quota
"""

_RUNS = secrets.RUN + "{%d,}"
_SPANS = """list_transform(
    range(1, len(m) + 1),
    lambda i: {{'b': (list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0))::INTEGER,
               'k': {kind}, 'e': (list_sum(list_transform(p[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))))::INTEGER,
               'm': m[i]}})"""


def _spans_sql(pattern: str, kind: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""SELECT uid, {_SPANS.format(kind=kind)} AS spans FROM (
    SELECT uid, string_split_regex(t, '{quoted}') AS p, regexp_extract_all(t, '{quoted}') AS m
    FROM doc WHERE regexp_matches(t, '{quoted}'))"""


def _secrets_sql() -> str:
    assign = secrets.ASSIGN.replace("'", "''")
    size, shown = len(secrets.ALPHABET), ", ".join(f"'{k}'" for k in secrets.KINDS)
    listed = ("array_to_string(list_transform({0}, lambda z: ([" + shown + "])[z.k + 1] || ':' || z.b || ':' || z.e), ',')")
    return f"""
WITH doc AS MATERIALIZED (
  SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS t, md5(doc_id::VARCHAR) AS rank FROM documents),
found AS MATERIALIZED (
  {_spans_sql(secrets.ASSIGN, 0)} UNION ALL {_spans_sql(secrets.ACCESS, 1)} UNION ALL {_spans_sql(secrets.HEX, 2)}
  UNION ALL {_spans_sql(_RUNS % secrets.JUDGED, 3)}),
span AS MATERIALIZED (
  SELECT uid, s.b, s.k, s.e, s.m FROM (SELECT uid, unnest(spans) AS s FROM found)
  WHERE s.k <> 0 OR length(regexp_extract(s.m, '{assign}', 2)) >= {secrets.SHORTEST_VALUE}),
taught AS (
  SELECT * FROM doc WHERE rank <= (SELECT max(rank) FROM (
    SELECT rank FROM doc WHERE rank IS NOT NULL ORDER BY rank LIMIT {secrets.TRAIN_DOCS}))),
sample AS (
  SELECT true AS random, unnest(list_transform(regexp_extract_all(t, '{assign}', 2), lambda v: replace(v, '.', ''))) AS value FROM taught
  UNION ALL SELECT true, unnest(regexp_extract_all(t, '{secrets.ACCESS}')) FROM taught
  UNION ALL SELECT true, unnest(regexp_extract_all(t, '{secrets.HEX}')) FROM taught
  UNION ALL SELECT true, to_base64(unhex(sha256(rank))) FROM taught
  UNION ALL SELECT true, sha256(rank)[1:40] FROM taught
  UNION ALL SELECT false, unnest(regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(
    t, '{assign}', ' ', 'g'), '{secrets.ACCESS}', ' ', 'g'), '{secrets.HEX}', ' ', 'g'), '{_RUNS % secrets.TAUGHT}')) FROM taught),
pair AS (
  SELECT random, value[i:i] AS a, value[i+1:i+1] AS b, count(*) AS n
  FROM (SELECT random, value, unnest(range(1, length(value))) AS i FROM sample WHERE length(value) > 1) GROUP BY ALL),
letter AS (SELECT unnest(string_split('{secrets.ALPHABET}', '')) AS c),
chance AS (
  SELECT r.random, x.c AS a, y.c AS b,
         (coalesce(p.n, 0) + 1) / (coalesce(sum(p.n) OVER (PARTITION BY r.random, x.c), 0) + {size}) AS p
  FROM (VALUES (true), (false)) r(random) CROSS JOIN letter x CROSS JOIN letter y
  LEFT JOIN pair p ON p.random = r.random AND p.a = x.c AND p.b = y.c),
ratio AS MATERIALIZED (
  SELECT u.a, u.b, CAST(floor(1000 * ln(u.p / v.p) + 0.5) AS BIGINT) AS w
  FROM chance u JOIN chance v ON u.random AND NOT v.random AND u.a = v.a AND u.b = v.b),
judged AS (SELECT DISTINCT m FROM span WHERE k = 3),
score AS (
  SELECT m, sum(w) AS w FROM (SELECT m, unnest(range(1, length(m))) AS i FROM judged) j
  JOIN ratio ON ratio.a = m[i:i] AND ratio.b = m[i+1:i+1] GROUP BY m),
kept AS (
  SELECT s.uid, s.b, s.k, s.e FROM span s LEFT JOIN score USING (m)
  WHERE s.k < 3 OR (score.w >= {secrets.LEAST} AND score.w >= {secrets.LEAST_EACH} * length(s.m)
    AND NOT EXISTS (SELECT 1 FROM span o WHERE o.uid = s.uid AND o.k < 3 AND o.b < s.e AND s.b < o.e))),
listed AS (
  SELECT uid, list({{'b': b, 'k': k, 'e': e}} ORDER BY b, k, e) AS s FROM kept GROUP BY uid)
SELECT doc_id, {", ".join(f"len(list_filter(coalesce(s, []), lambda x: x.k = {i}))::BIGINT AS n_{name}" for i, name in enumerate(secrets.KINDS))},
  sha256(coalesce({listed.format("list_filter(s, lambda x: x.k < 3)")}, '')) AS base_sha256,
  coalesce({listed.format("s")}, '') AS spans
FROM doc LEFT JOIN listed USING (uid)
"""


ORACLE["op3_secrets"] = _secrets_sql()
