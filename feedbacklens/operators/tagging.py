"""Tagging feedback with its nearest label (our own definition)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .similarity import BLOCK_ROWS, STEPS


def label_vectors(df: DataFrame, label: str, vec: str) -> DataFrame:
    """``(tag, vec)``: element-wise mean of a label's vectors, with partial sums."""
    cells = df.select(F.col(label).alias("tag"), F.posexplode(
        F.col(vec).cast("array<double>")).alias("_dim", "_x"))
    means = cells.groupBy("tag", "_dim").agg(F.avg("_x").alias("_x"))
    return means.groupBy("tag").agg(
        F.array_sort(F.collect_list(F.struct("_dim", "_x")))["_x"].alias("vec"))


def tag_label(feedback: DataFrame, labels: DataFrame,
              block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(id, tag, score)``: the label with the highest cosine; ties to the lowest tag.

    ``feedback`` is ``(id, vec)`` and ``labels`` ``(tag, vec)`` with integer tags.
    Blocks of feedback meet blocks of labels, and each meeting emits one row per
    feedback, so neither side has to fit in a task.
    """
    label_blocks = labels.agg(
        F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("_blocks"))
    feedback_blocks = feedback.agg(
        F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("_blocks"))
    n_labels, n_feedback = label_blocks.first()[0], feedback_blocks.first()[0]
    vec = F.col("vec").cast("array<double>").alias("vec")
    block = lambda column, n: F.pmod(F.xxhash64(column), F.lit(max(n, 1))).cast("int")
    left = feedback.select("id", vec, block("id", n_feedback).alias("a")).withColumn(
        "b", F.explode(F.sequence(F.lit(0), F.lit(max(n_labels, 1) - 1))))
    right = labels.select(F.col("tag").cast("long").alias("id"), vec,
                          block("tag", n_labels).alias("b")).withColumn(
        "a", F.explode(F.sequence(F.lit(0), F.lit(max(n_feedback, 1) - 1))))

    def task(key, ours, theirs):
        import pyarrow as pa

        from .similarity import _matrix

        schema = pa.schema([("id", pa.int64()), ("q", pa.int64()), ("tag", pa.int64())])
        if not ours.num_rows or not theirs.num_rows:
            return schema.empty_table()
        theirs = theirs.sort_by("id")
        cs = np.rint(_matrix(ours["vec"]) @ _matrix(theirs["vec"]).T * STEPS).astype(np.int64)
        at = cs.argmax(axis=1)
        return pa.table({
            "id": ours["id"].to_numpy(), "q": cs[np.arange(len(at)), at],
            "tag": theirs["id"].to_numpy()[at]}, schema=schema)

    partial = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(
        task, "id long, q long, tag long")
    best = partial.groupBy("id").agg(
        F.max(F.struct("q", (-F.col("tag")).alias("neg"))).alias("_m"))
    return best.select("id", (-F.col("_m.neg")).alias("tag"),
                       (F.col("_m.q") / F.lit(float(STEPS))).alias("score"))
