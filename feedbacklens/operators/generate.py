"""Pluggable text generation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import text as T
from ..functions.arrays import pin
from ..functions.matching import SLICE_ROWS, sentence_scores
from ..plans.resources import STOP_WORDS
from .keyphrases import by_key, phrase_array, shuffled_keyphrases


def generate(df: DataFrame, fn: Callable[[pd.Series], Sequence[str]], article: str = "article",
             out: str = "generated", rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``out`` by running ``fn`` on series of up to ``rows`` articles in parallel tasks.

    Only a series at a time leaves the Arrow batch and comes back as a batch of its own, so
    that a task's memory does not follow the number of rows it is sent at once.
    """

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                texts = list(fn(part.column(article).to_pandas()))
                made = pa.array(texts, pa.string(), from_pandas=True)
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, out])

    schema = StructType([*df.schema.fields, StructField(out, StringType())])
    return df.mapInArrow(run, schema)


def lead_sentences(df: DataFrame, key: str, article: str, sentences: int = 2,
                   stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Default generator: ``(key, generated)``, the sentences richest in key phrases.

    A sentence scores the sum of the scores of its own phrases.  The best
    ``sentences`` are given in text order.
    """
    single, repeated = by_key(df.select(key, article), key)
    cells = pin(single, _sentences=T.sentences(F.col(article)), _phrases=phrase_array(F.col(article), stop_words))
    own = F.transform("_sentences", lambda s: phrase_array(s, stop_words))
    scored = cells.filter(F.size("_sentences") > 0).select(
        key, "_sentences", sentence_scores("_phrases", own).alias("_scores"))
    best = F.slice(F.array_sort(F.transform(
        F.arrays_zip(F.col("_scores").alias("score"), F.col("_sentences").alias("sentence")),
        lambda c, i: F.struct((-c["score"]).alias("neg"), i.alias("place"), c["sentence"].alias("sentence")))), 1, sentences)
    chosen = scored.select(key, best.alias("_best"))
    if repeated is not None:
        chosen = chosen.unionByName(_best_of_repeated(repeated, key, article, sentences, stop_words))
    text = F.array_join(F.transform(F.array_sort(F.transform(
        F.col("_best"), lambda s: F.struct(s["place"].alias("place"), s["sentence"].alias("sentence")))),
        lambda s: s["sentence"]), " ")
    return chosen.select(key, text.alias("generated"))


def _best_of_repeated(df: DataFrame, key: str, article: str, sentences: int, stop_words: Sequence[str]) -> DataFrame:
    """``(key, _best)`` of rows that share their key: their sentences and phrases meet by shuffle."""
    phrases = shuffled_keyphrases(df, key, article, stop_words).select(key, "phrase", "score")
    rows = df.select(key, F.posexplode(T.sentences(F.col(article))).alias("place", "sentence"))
    own = rows.select(key, "place", F.explode(
        phrase_array(F.col("sentence"), stop_words)).alias("phrase"))
    scored = own.join(phrases, [key, "phrase"]).groupBy(key, "place").agg(
        F.round(F.sum("score"), 6).alias("score"))
    return rows.join(scored, [key, "place"], "left").groupBy(key).agg(F.slice(F.array_sort(
        F.collect_list(F.struct((-F.coalesce("score", F.lit(0.0))).alias("neg"), "place", "sentence"))
    ), 1, sentences).alias("_best"))
