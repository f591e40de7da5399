"""Queries over generated text: cleaning, key phrases, candidates, words, vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import pin
from ..operators import keyphrases as K, lexical, titles
from ..plans.resources import LEMMAS, OMIT_WORDS, STOP_WORDS
from ..sources import readers
from . import fixtures as X
from .preparation import TOKEN_SQL

QUERIES = {}
ORACLE = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return add


def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


NAMES = ["than", "ther", "tion"]
REPAIR_SQL = "replace(replace(replace(text, ' .', '. '), '-lrb-', ''), '-rrb-', '')"
CLEANED_SQL = f"""array_to_string(list_filter(
    regexp_extract_all(regexp_replace({REPAIR_SQL}, '(?i)\\[unk\\]', '', 'g'), {TOKEN_SQL}),
    lambda t: lower(t) NOT IN ({sql_list(OMIT_WORDS + NAMES)})), ' ')"""


@query(f"SELECT doc_id AS index, {REPAIR_SQL} AS generated, source AS label FROM documents WHERE text <> ''")
def generated_parse(spark, sf):
    docs = X.table(spark, sf, "documents")
    files = docs.select(
        F.format_string("%06d_decoded.txt", "doc_id").alias("file_name"),
        F.concat(F.lit("Original Feedback: "), T.one_line(F.col("text")),
                 F.lit(f"\n\n{T.GENERATED_MARK} \n"), "text").alias("value"))
    feedback = docs.select(F.col("doc_id").alias("index"), F.col("source").alias("label"))
    joined = readers.attach_generated(feedback, readers.parse_generated(files))
    return joined.withColumn("generated", T.clean_generated(F.col("generated")))


@query(f"SELECT doc_id, coalesce({CLEANED_SQL}, '') AS cleaned FROM documents")
def token_exclusion(spark, sf):
    return X.table(spark, sf, "documents").select(
        "doc_id", K.cleaned_text(F.col("text"), NAMES).alias("cleaned"))


@query(f"""
SELECT doc_id, coalesce(array_to_string(list_filter(regexp_extract_all(text, {TOKEN_SQL}),
       lambda t: lower(t) NOT IN ({sql_list(NAMES)})), ' '), '') AS text FROM documents""")
def name_exclusion(spark, sf):
    names = spark.createDataFrame([(n,) for n in NAMES], "name string")
    return K.remove_names(
        X.table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text", names)


def phrase_sql(source: str) -> str:
    """RAKE steps over ``source(doc_id, body)``."""
    return f"""
ptok AS (SELECT doc_id, unnest(l) AS t, generate_subscripts(l, 1) AS pos FROM (
  SELECT doc_id, regexp_extract_all(lower(body), {TOKEN_SQL}) AS l FROM {source})),
pbreak AS (SELECT *, CASE WHEN t IN ({sql_list(STOP_WORDS)}) OR NOT regexp_matches(t, '^[a-z0-9à-ÿÀ-ß]')
                     THEN 1 ELSE 0 END AS b FROM ptok),
pisle AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM pbreak),
phrase AS (SELECT DISTINCT doc_id, phrase FROM (
  SELECT doc_id, g, string_agg(t, ' ' ORDER BY pos) AS phrase FROM pisle WHERE b = 0
  GROUP BY doc_id, g)),
pword AS (SELECT doc_id, phrase, len(string_split(phrase, ' ')) AS n,
                 unnest(string_split(phrase, ' ')) AS w FROM phrase),
pscore AS (SELECT doc_id, w, sum(n) / count(*) AS s FROM pword GROUP BY doc_id, w),
pranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, phrase DESC) AS rank
  FROM (SELECT p.doc_id, p.phrase, round(sum(s) + 1e-9, 6) AS score
        FROM pword p JOIN pscore x ON x.doc_id = p.doc_id AND x.w = p.w GROUP BY p.doc_id, p.phrase))"""


@query(f"""WITH body AS (SELECT doc_id, text AS body FROM documents), {phrase_sql('body')}
SELECT doc_id, phrase, score, CAST(rank AS INTEGER) AS rank FROM pranked""")
def keyphrases(spark, sf):
    return K.keyphrases(X.table(spark, sf, "documents"), "doc_id", "text")


def generated_docs(spark, sf):
    return X.table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("label"), F.col("text").alias("feedback"),
        F.col("text").alias("generated"))


CANDIDATE_SQL = f"""
body AS (SELECT doc_id, source AS label, {CLEANED_SQL} AS body FROM documents),
{phrase_sql('body')},
frag AS (SELECT doc_id, trim(f) AS f, i FROM (
  SELECT doc_id, unnest(l) AS f, generate_subscripts(l, 1) AS i FROM (
    SELECT doc_id, regexp_split_to_array(body, '[.?!]') AS l FROM body)) WHERE trim(f) <> ''),
hit AS (SELECT f.doc_id, f.f, f.i, min(p.rank) AS r FROM frag f
  JOIN pranked p ON p.doc_id = f.doc_id AND contains(lower(f.f), p.phrase) GROUP BY 1, 2, 3),
first_hit AS (SELECT doc_id, f, min(struct_pack(r := r, i := i)) AS k FROM hit GROUP BY doc_id, f),
candidate AS (
  SELECT doc_id, f AS concept, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS place
  FROM first_hit WHERE len(regexp_extract_all(f, {TOKEN_SQL})) > 3)"""


@query(f"""WITH {CANDIDATE_SQL}
SELECT c.doc_id, b.label, CAST(c.place AS INTEGER) AS place, c.concept
FROM candidate c JOIN body b USING (doc_id)""")
def concept_candidates(spark, sf):
    return K.concept_candidates(generated_docs(spark, sf), "doc_id", NAMES).drop("feed")


UPPER_SQL = "replace(upper(t), 'ẞ', 'SS')"


@query(f"""WITH a AS (
  SELECT doc_id, regexp_extract_all(lower(text), {TOKEN_SQL}) AS l,
         list_filter(regexp_extract_all(text, {TOKEN_SQL}),
                     lambda t: t = {UPPER_SQL} AND t <> lower(t) AND t <> 'A') AS acr FROM documents)
SELECT doc_id, CAST(len(list_distinct(acr)) AS INTEGER) AS n_acronyms,
       coalesce(array_to_string(list_transform(l, lambda t: CASE WHEN list_contains(acr, {UPPER_SQL})
                                THEN {UPPER_SQL} ELSE t END), ' '), '') AS restored FROM a""")
def acronym_restore(spark, sf):
    docs = pin(X.table(spark, sf, "documents"), known=T.acronyms(F.col("text")))
    restored = T.restore_acronyms(T.tokens(F.lower("text")), F.col("known"))
    return docs.select("doc_id", F.size("known").alias("n_acronyms"),
                       F.array_join(restored, " ").alias("restored"))


@query()
def title_removal(spark, sf):
    docs = X.with_highlight(spark, sf).select(
        "doc_id", F.col("concept").alias("label"), F.col("text").alias("concept"),
        F.col("text").alias("feed"))
    return titles.remove_title_text(docs, 60)


WORD_SQL = "'[A-Za-z0-9À-ÿ]+(?:[''-][A-Za-z0-9À-ÿ]+)*'"
CORPUS_SQL = f"""
corpus AS MATERIALIZED (SELECT word, count(*) AS cnt FROM (
  SELECT unnest(regexp_extract_all(lower(text), {WORD_SQL})) AS word FROM documents) GROUP BY word),
dictionary AS MATERIALIZED (SELECT * FROM corpus WHERE cnt >= 50)"""


def corpus_words(spark, sf):
    return (
        X.table(spark, sf, "documents").select(F.explode(T.words(F.lower("text"))).alias("word"))
        .groupBy("word").agg(F.count("*").alias("cnt"))
    )


# One byte per letter, because the distance function below counts bytes.
ACCENTED = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß×÷"
SINGLE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ!@#$%^&*"[: len(ACCENTED)]


@query(f"""WITH {CORPUS_SQL},
plain AS MATERIALIZED (SELECT word, cnt, translate(word, '{ACCENTED}', '{SINGLE}') AS p FROM corpus),
keyed AS MATERIALIZED (SELECT word, cnt, p, unnest(list_append(list_transform(range(1, length(p) + 1),
            lambda i: substr(p, 1, i - 1) || substr(p, i + 1)), p)) AS k FROM plain),
pair AS MATERIALIZED (SELECT DISTINCT c.word, d.word AS entry, d.cnt FROM keyed c JOIN keyed d ON c.k = d.k
  WHERE c.cnt < 50 AND d.cnt >= 50 AND damerau_levenshtein(c.p, d.p) = 1),
best AS MATERIALIZED (SELECT word, arg_min(entry, struct_pack(c := -cnt, e := entry)) AS entry FROM pair GROUP BY word)
SELECT c.word, coalesce(b.entry, c.word) AS corrected FROM corpus c LEFT JOIN best b USING (word)""")
def spell_correct(spark, sf):
    words = corpus_words(spark, sf)
    return lexical.correct_words(words, words.filter("cnt >= 50"))


LEMMA_SQL = "CASE " + " ".join(
    f"WHEN word = '{form}' THEN '{lemma}'" for form, lemma in LEMMAS) + """
  WHEN suffix(word, 'sses') AND length(word) >= 5 THEN left(word, length(word) - 4) || 'ss'
  WHEN suffix(word, 'ies') AND length(word) >= 5 THEN left(word, length(word) - 3) || 'y'
  WHEN suffix(word, 'ings') AND length(word) >= 7 THEN left(word, length(word) - 4)
  WHEN suffix(word, 'ing') AND length(word) >= 6 THEN left(word, length(word) - 3)
  WHEN suffix(word, 'ed') AND length(word) >= 5 THEN left(word, length(word) - 2)
  WHEN suffix(word, 's') AND NOT suffix(word, 'ss') AND length(word) >= 4 THEN left(word, length(word) - 1)
  ELSE word END"""


@query(f"""WITH {CORPUS_SQL}, l AS (SELECT word, {LEMMA_SQL} AS lemma FROM corpus
  WHERE word NOT IN ({sql_list([*STOP_WORDS, 'be'])}))
SELECT word, lemma FROM l WHERE lemma NOT IN ({sql_list([*STOP_WORDS, 'be'])})""")
def lemmatise(spark, sf):
    return lexical.lemmatise(corpus_words(spark, sf))


def corpus_vectors(spark, sf):
    """Word vectors: the most frequent corpus words get the embedding rows in order."""
    from ..operators.vocab import assign_ids

    ids = assign_ids(corpus_words(spark, sf))
    return ids.join(
        X.table(spark, sf, "embeddings").select(
            F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("vec")), "id"
    ).filter("id >= 4").select("word", "vec")


CORPUS_VECTOR_SQL = CORPUS_SQL + """,
word_vector AS (
  SELECT word, CAST(e.embedding AS DOUBLE[]) AS vec FROM (
    SELECT word, row_number() OVER (ORDER BY cnt DESC, word) + 3 AS id FROM corpus) r
  JOIN embeddings e ON e.vec_id = r.id)"""


@query(f"""WITH {CORPUS_VECTOR_SQL},
w AS (SELECT item_id, word, count(*) AS n FROM (
  SELECT item_id, unnest(regexp_extract_all(lower(text), {WORD_SQL})) AS word FROM benchmark)
  GROUP BY item_id, word),
x AS (SELECT item_id, dim, sum(n * v) AS v FROM (
  SELECT item_id, n, unnest(vec) AS v, generate_subscripts(vec, 1) AS dim
  FROM w JOIN word_vector USING (word)) GROUP BY item_id, dim),
nrm AS (SELECT item_id, sqrt(sum(v * v)) AS r FROM x GROUP BY item_id),
grid AS (SELECT item_id, unnest(range(1, 65)) AS dim FROM benchmark)
SELECT g.item_id, CAST(g.dim - 1 AS INTEGER) AS dim,
       round(CASE WHEN coalesce(r, 0) = 0 THEN 0.0 ELSE v / r END, 6) + 0.0 AS value
FROM grid g LEFT JOIN x ON x.item_id = g.item_id AND x.dim = g.dim
LEFT JOIN nrm n ON n.item_id = g.item_id""")
def concept_vectors(spark, sf):
    concepts = X.table(spark, sf, "benchmark")
    rows = lexical.concept_words(concepts, "item_id", "text")
    vectors = lexical.concept_vectors(concepts, "item_id", rows, corpus_vectors(spark, sf), 64)
    return vectors.select("item_id", F.posexplode("vec").alias("dim", "value")).withColumn(
        "value", F.round("value", 6) + 0.0)
