"""Endless shuffled passes: every record once a pass, other orders, restarts."""

import pytest
from pyspark.sql import functions as F

from feedbacklens.session import scratch_path
from feedbacklens.streaming import passes


@pytest.mark.parametrize("records", [1, 2, 3, 10, 97, 100, 1_000])
def test_every_record_has_one_place(spark, records):
    high, width = passes.grid(records)
    assert records <= high * width < records + width
    places = spark.range(2 * high * width).select(
        F.floor(F.col("id") / (high * width)).cast("long").alias("pass"), F.pmod("id", F.lit(high * width)).alias("place"))
    rows = places.withColumn("record", passes.record_at(F.col("pass"), F.col("place"), records)).orderBy("pass", "place").collect()
    orders = [[r.record for r in rows if r["pass"] == p] for p in (0, 1)]
    assert all(sorted(o) == list(range(high * width)) for o in orders)
    if records > 10:
        assert orders[0] != orders[1] and orders[0] != sorted(orders[0])
        near = sum(abs(a - b) == 1 for a, b in zip(orders[0], orders[0][1:]))
        assert near < 0.2 * records


def test_stream_goes_on_after_restarts(spark):
    """Micro-batches that cut passes anywhere, each by a query of its own, give whole passes in order."""
    table = spark.range(50).select(F.col("id").alias("record"), F.concat(F.lit("text "), "id").alias("article"))
    stream = lambda seed: passes.endless_passes(spark, table, 50, 30, seed=seed, partitions=3)
    out = scratch_path(spark, "passes")
    for _ in range(4):
        passes.run_batch(stream(1), out)
    rows = spark.read.parquet(out).collect()
    high, width = passes.grid(50)
    assert len(rows) == len({(r["pass"], r.record) for r in rows}) and all(r.article == f"text {r.record}" for r in rows)
    assert {r["pass"] * high * width + r.place for r in rows} <= set(range(120))
    for p in (0, 1):
        assert sorted(r.record for r in rows if r["pass"] == p) == list(range(50))
    other = scratch_path(spark, "passes")
    passes.run_batch(stream(2), other)
    first = lambda path: [r.record for r in spark.read.parquet(path).filter("pass = 0 and place < 30").orderBy("place").collect()]
    assert first(out) != first(other)
