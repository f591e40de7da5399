"""Labels, the held-out part, and the fit of a score to a probability."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .columns import column

#: Rows of labels (about 16 bytes each) up to which they are sent to every task.
BROADCAST_ROWS = 1_000_000


def fold(key: Column) -> Column:
    """``crc32(key as text) mod 3``; null keys count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(3)).cast("int")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str) -> DataFrame:
    """``(fold, label, text)`` of labelled rows outside fold 1.

    The text stays where it is while the labels are few enough to be sent to it; beyond
    that number both sides are shuffled.  Rows without a key or label are left out; if a
    key has several labels, the highest counts.
    """
    known = (labels.select(column(key).alias("key"), column(label).cast("int").alias("label"))
             .filter(F.col("key").isNotNull() & F.col("label").isNotNull() & (fold(F.col("key")) != 1))
             .groupBy("key").agg(F.max("label").alias("label")))
    if labels.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    own = docs.select(column(key).alias("key"), column(text).alias("text"))
    return (own.filter(F.col("key").isNotNull() & (fold(F.col("key")) != 1)).join(known, "key")
            .select("key", fold(F.col("key")).alias("fold"), "label", "text"))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept by Newton's method; the ridge keeps them finite for separable data."""
    slope, intercept = 0.0, 0.0
    rows = np.stack([x, np.ones_like(x)], axis=1)
    total = weight.sum()
    if not total:
        return 0.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + intercept, -30, 30)))
        gradient = rows.T @ (weight * (y - p)) / total - ridge * np.array([slope, 0.0])
        curve = (rows * (weight * p * (1 - p))[:, None]).T @ rows / total + np.diag([ridge, 1e-9])
        step = np.clip(np.linalg.solve(curve, gradient), -2, 2)
        slope, intercept = slope + step[0], intercept + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(slope), float(intercept)
