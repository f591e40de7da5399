"""How the given tables stand in for the engine's inputs, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import prepare, stories, vocab
from ..sources.readers import spread

ENC_STEPS, DEC_STEPS = 400, 100
SMALL_VOCAB = 2_000
TEXT_KEYS = {"documents": "doc_id", "conversations": "conv_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, TEXT_KEYS[name]) if name in TEXT_KEYS else df


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as feedback ``(sno, feedback, label)``."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("sno"), F.col("text").alias("feedback"),
        F.col("source").alias("label"))


def concept_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as two 0/1 concept files with different columns."""
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "sno")
    return prepare.append([labels.select("sno", "quality"), labels.select("sno", "toxic")])


def with_highlight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with one benchmark passage as its concept."""
    passages = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("_item"), F.col("text").alias("concept"))
    count = passages.count()
    docs = table(spark, sf_dir, "documents")
    return docs.join(passages, F.col("doc_id") % count == F.col("_item")).drop("_item")


def story(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_highlight(spark, sf_dir).withColumnRenamed("text", "feedback")
    return stories.make_stories(docs).select("doc_id", "story")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stories.usable_records(stories.parse_stories(story(spark, sf_dir)))


def small_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocab.build_vocab(records(spark, sf_dir), max_size=SMALL_VOCAB)


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocab.encode(records(spark, sf_dir), small_vocab(spark, sf_dir), SMALL_VOCAB,
                        "doc_id", ENC_STEPS, DEC_STEPS)


STRIP = "' ' || chr(9) || chr(13) || chr(10) || chr(11) || chr(12)"

STORY_SQL = """
story AS MATERIALIZED (
  SELECT d.doc_id,
         d.text || chr(10) || chr(10) || '@highlight' || chr(10) || b.text AS story
  FROM documents d
  JOIN benchmark b ON b.item_id = d.doc_id % (SELECT count(*) FROM benchmark))"""

PARSE_SQL = STORY_SQL + f""",
story_line AS (
  SELECT doc_id, list_filter(list_transform(list_transform(string_split(story, chr(10)),
      lambda l: replace(replace(replace(replace(replace(lower(trim(l, {STRIP})),
        '``', ''), '-rrb-', ''), '-lrb-', ''), '--', ''), '...', '')),
      lambda l: CASE WHEN contains(l, '@highlight') OR l = ''
                       OR right(l, 1) IN ('.', '!', '?', '''', '`', '"', '’', '”', ')')
                     THEN l ELSE l || ' .' END),
      lambda l: l <> '') AS lines
  FROM story),
story_mark AS (
  SELECT doc_id, lines,
         coalesce(list_position(list_transform(lines,
           lambda l: starts_with(l, '@highlight')), true), 0) AS first
  FROM story_line),
parsed AS MATERIALIZED (
  SELECT doc_id,
         array_to_string(CASE WHEN first = 0 THEN lines ELSE lines[1:first - 1] END, ' ') AS article,
         coalesce(array_to_string(list_transform(
           list_filter(CASE WHEN first = 0 THEN [] ELSE lines[first:] END,
                       lambda l: NOT starts_with(l, '@highlight')),
           lambda l: '<s> ' || l || ' </s>'), ' '), '') AS abstract
  FROM story_mark),
record AS MATERIALIZED (SELECT * FROM parsed WHERE length(article) > 0)"""

VOCAB_SQL = PARSE_SQL + """,
token AS MATERIALIZED (
  SELECT unnest(list_concat(string_split(article, ' '),
         list_filter(string_split(abstract, ' '), lambda t: t NOT IN ('<s>', '</s>')))) AS word
  FROM record),
word_count AS MATERIALIZED (
  SELECT word, count(*) AS cnt FROM (SELECT trim(word, """ + STRIP + """) AS word FROM token)
  WHERE word <> '' GROUP BY word),
word_rank AS MATERIALIZED (
  SELECT word, row_number() OVER (ORDER BY cnt DESC, word) AS r, cnt FROM word_count)"""


def vocab_sql(size: int) -> str:
    return VOCAB_SQL + f""",
vocab AS MATERIALIZED (
  SELECT * FROM (VALUES ('[UNK]', 0, NULL::BIGINT), ('[PAD]', 1, NULL), ('[START]', 2, NULL),
                        ('[STOP]', 3, NULL)) v(word, id, cnt)
  UNION ALL
  SELECT word, CAST(r + 3 AS INTEGER), cnt FROM word_rank WHERE r <= {size} - 4)"""


ENCODE_SQL = vocab_sql(SMALL_VOCAB) + f""",
doc_words AS MATERIALIZED (
  SELECT doc_id,
         list_filter(regexp_split_to_array(article, '\\s+'), lambda t: t <> '')[1:{ENC_STEPS}] AS aw,
         list_filter(regexp_split_to_array(array_to_string(list_transform(
           regexp_extract_all(abstract, '(?s)<s>(.*?)</s>', 1), lambda s: trim(s)), ' '), '\\s+'),
           lambda t: t <> '') AS bw
  FROM record),
art_token AS MATERIALIZED (
  SELECT doc_id, t.pos, t.word, coalesce(v.id, 0) AS id
  FROM (SELECT doc_id, unnest(aw) AS word, generate_subscripts(aw, 1) AS pos FROM doc_words) t
  LEFT JOIN vocab v ON v.word = t.word),
oov AS MATERIALIZED (
  SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY min(pos)) - 1 AS o
  FROM art_token WHERE id = 0 GROUP BY doc_id, word),
art AS MATERIALIZED (
  SELECT a.doc_id, count(*) AS enc_len,
         list(a.id ORDER BY a.pos) AS enc,
         list(CASE WHEN o.o IS NULL THEN a.id ELSE {SMALL_VOCAB} + o.o END ORDER BY a.pos) AS ext
  FROM art_token a LEFT JOIN oov o ON o.doc_id = a.doc_id AND o.word = a.word AND a.id = 0
  GROUP BY a.doc_id),
oov_list AS (
  SELECT doc_id, list(word ORDER BY o) AS oovs FROM oov GROUP BY doc_id),
abs_token AS MATERIALIZED (
  SELECT doc_id, t.pos, t.word, coalesce(v.id, 0) AS id
  FROM (SELECT doc_id, unnest(bw) AS word, generate_subscripts(bw, 1) AS pos FROM doc_words) t
  LEFT JOIN vocab v ON v.word = t.word),
abst AS MATERIALIZED (
  SELECT a.doc_id, list(a.id ORDER BY a.pos) AS ids,
         list(CASE WHEN a.id <> 0 THEN a.id WHEN o.o IS NULL THEN 0
                   ELSE {SMALL_VOCAB} + o.o END ORDER BY a.pos) AS ext
  FROM abs_token a LEFT JOIN oov o ON o.doc_id = a.doc_id AND o.word = a.word
  GROUP BY a.doc_id)"""
