"""A corpus pipeline: toxic texts out, near copies out, secrets masked, sources mixed, encoded.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept;
``docs`` has the columns of ``documents``, and so has what every stage but the last returns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedbacklens.llm import byte_bpe, mixing, secrets, simhash, toxicity
from feedbacklens.session import cut

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go; all others stay, unlabelled ones too."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_texts(docs, labels).filter("predicted = 0").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays, that with the smallest id; a null id comes last.

    Fingerprints of three-word shingles that differ in at most two bits make near-duplicates.
    """
    return simhash.one_of_each(docs.select(*COLUMNS), words=3, radius=2)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; ``n_chars`` follows.  No document goes."""
    masked = secrets.redact(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A tenth of the tokens goes where the target weights ask for less; nothing is read twice."""
    counted = docs.select(*COLUMNS, mixing.word_count(F.col("text")).alias("tokens"))
    return mixing.mix_sources(counted, budget_share=0.9, max_epochs=1).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their number, and whether decoding them gives the text again."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode_texts(docs.select(*COLUMNS), path).select(
        "doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "round_trip")


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_copies), ("secrets", mask_secrets),
          ("mixing", mix), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Hashes, models and the encoder are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
