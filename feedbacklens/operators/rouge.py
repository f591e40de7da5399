"""Overlap quality of generated against reference texts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from ..functions.arrays import pin
from ..functions.matching import lcs

REPLICATES = 1_000


def _grams(words: Column, n: int) -> Column:
    if n == 1:
        return words
    ends = F.filter(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))),
                    lambda i: i + n - 1 <= F.size(words))
    return F.transform(ends, lambda i: F.array_join(F.slice(words, i, n), " "))


def _scores(hit: Column, reference: Column, candidate: Column) -> list[Column]:
    recall = F.when(reference == 0, 0.0).otherwise(hit / reference)
    precision = F.when(candidate == 0, 0.0).otherwise(hit / candidate)
    f_score = F.when(hit == 0, 0.0).otherwise(2.0 * hit / (reference + candidate))
    return [recall.alias("recall"), precision.alias("precision"), f_score.alias("f_score")]


def rouge_n(pairs: DataFrame, key: str, n: int) -> DataFrame:
    """``(key, recall, precision, f_score)`` from clipped n-gram counts.

    Both texts go into one aggregate per (pair, n-gram), so no join is needed
    and counts combine on the map side.
    """
    cell = lambda column, side: F.transform(
        _grams(F.col(column), n),
        lambda g: F.struct(g.alias("gram"), F.lit(side).alias("side")))
    words = pin(pairs.select(key, "reference", "candidate"),
                _r=T.words(F.lower("reference")), _c=T.words(F.lower("candidate")))
    grams = words.select(key, F.explode_outer(
        F.concat(cell("_r", 0), cell("_c", 1))).alias("_g"))
    counts = grams.groupBy(key, F.col("_g.gram").alias("gram")).agg(
        F.count_if(F.col("_g.side") == 0).alias("r"), F.count_if(F.col("_g.side") == 1).alias("c"))
    sums = counts.groupBy(key).agg(
        F.sum(F.least("r", "c")).alias("hit"), F.sum("r").alias("r"), F.sum("c").alias("c"))
    return sums.select(key, *_scores(F.col("hit"), F.col("r"), F.col("c")))


def rouge_l(pairs: DataFrame, key: str) -> DataFrame:
    """``(key, recall, precision, f_score)`` from the longest common word sequence."""
    words = pairs.select(key, T.words(F.lower("reference")).alias("r"),
                         T.words(F.lower("candidate")).alias("c"))
    return words.withColumn("hit", lcs("r", "c")).select(
        key, *_scores(F.col("hit"), F.size("r"), F.size("c")))


def rouge(pairs: DataFrame, key: str) -> DataFrame:
    """Scores of every pair for the metrics 1, 2 and l."""
    parts = [rouge_n(pairs, key, 1).withColumn("metric", F.lit("1")),
             rouge_n(pairs, key, 2).withColumn("metric", F.lit("2")),
             rouge_l(pairs, key).withColumn("metric", F.lit("l"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def rouge_means(scores: DataFrame) -> DataFrame:
    return scores.groupBy("metric").agg(
        *[F.avg(c).alias(c) for c in ("recall", "precision", "f_score")])


def _poisson(keys: np.ndarray, replicates: int) -> np.ndarray:
    """Poisson(1) counts fixed by (key, replicate), whatever the partitioning."""
    with np.errstate(over="ignore"):
        z = keys[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(
            1, replicates + 1, dtype=np.uint64)[None, :] * np.uint64(0xD1B54A32D192ED03)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    uniform = (z >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    terms = np.exp(-1.0) / np.cumprod(np.r_[1.0, np.arange(1.0, 16.0)])
    return np.searchsorted(np.cumsum(terms), uniform)


def rouge_interval(scores: DataFrame, key: str, replicates: int = REPLICATES,
                   level: float = 0.95) -> DataFrame:
    """Corpus means with a bootstrap interval per metric and measure.

    Each task weights its own rows for all replicates and emits only weighted
    sums: ``replicates`` rows per metric and task, however many pairs there are.
    """
    measures = ("recall", "precision", "f_score")

    def weigh(batches):
        totals = {}
        for pdf in batches:
            for metric, part in pdf.groupby("metric"):
                for start in range(0, len(part), 2_000):
                    rows = part.iloc[start:start + 2_000]
                    weight = _poisson(rows["_h"].to_numpy().astype(np.uint64), replicates)
                    value = rows[list(measures)].to_numpy()
                    sums = np.c_[weight.sum(axis=0), weight.T @ value]
                    totals[metric] = totals.get(metric, 0) + sums
        for metric, sums in totals.items():
            yield pd.DataFrame({
                "metric": metric, "replicate": np.arange(replicates), "n": sums[:, 0].astype(float),
                **{m: sums[:, i + 1] for i, m in enumerate(measures)}})

    partial = scores.select("metric", *measures, F.xxhash64(key).alias("_h")).mapInPandas(
        weigh, "metric string, replicate long, n double, recall double, precision double, f_score double")
    means = partial.groupBy("metric", "replicate").agg(
        *[(F.sum(m) / F.sum("n")).alias(m) for m in measures])
    tail = (1 - level) / 2
    bounds = means.groupBy("metric").agg(*[
        F.percentile(m, F.lit(q)).alias(f"{m}_{end}")
        for m in measures for end, q in (("cb", tail), ("ce", 1 - tail))])
    return rouge_means(scores).join(bounds, "metric")


def report_lines(interval: DataFrame) -> DataFrame:
    """One text line per metric and measure, four decimals, with the interval."""
    rows = None
    for place, measure in enumerate(("f_score", "recall", "precision")):
        part = interval.select(
            "metric", F.lit(place).alias("place"),
            F.format_string(
                f"rouge_%s_{measure}: %.4f with confidence interval (%.4f, %.4f)",
                "metric", measure, f"{measure}_cb", f"{measure}_ce").alias("value"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.orderBy("metric", "place").select("value")
