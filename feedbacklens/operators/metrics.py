"""Audits of metric logs, values and attention weights."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.ordering import sum_before

DECAY, CLIP = 0.99, 12.0
CHUNK_STEPS, CHUNKS_PER_BLOCK = 1_000, 1_000


def require_finite(df: DataFrame, column: str) -> DataFrame:
    """Fail the job on a value that is not finite."""
    bad = ~is_finite(F.col(column))
    return df.withColumn(column, F.when(bad, F.raise_error("value is not finite")).otherwise(
        F.col(column)))


def is_finite(value: Column) -> Column:
    return (~F.isnan(value)) & (F.abs(value) != float("inf"))


def _carry_state(start: Column, cells: Column) -> Column:
    """States before each of the ordered affine steps ``min(a*x + b, c)``."""
    step = lambda x, s: F.least(s["a"] * x + s["b"], s["c"])
    return F.aggregate(
        cells,
        F.struct(start.alias("x"), F.array().cast("array<double>").alias("before")),
        lambda acc, s: F.struct(step(acc["x"], s).alias("x"),
                                F.concat(acc["before"], F.array(acc["x"])).alias("before")),
    )["before"]


def _compose(cells: Column) -> Column:
    """One affine step equal to the ordered steps in turn."""
    first = F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b"),
                     F.lit(float("inf")).alias("c"))
    return F.aggregate(cells, first, lambda f, s: F.struct(
        (f["a"] * s["a"]).alias("a"), (s["a"] * f["b"] + s["b"]).alias("b"),
        F.least(s["a"] * f["c"] + s["b"], s["c"]).alias("c")))


def running_loss(df: DataFrame, series: str, step: str, loss: str,
                 decay: float = DECAY, clip: float = CLIP, start: DataFrame | None = None) -> DataFrame:
    """Add ``running_avg``: the decayed average, clipped, the clip feeding back.

    The first non-zero loss seeds the average.  Losses are at least 0 and steps
    are unique integers inside a series.  ``start (series, running_avg)`` has the averages
    that series come with, one row each; others start at 0.

    A step is ``x -> min(d*x + (1-d)*loss, clip)``, and such steps compose into
    one of the same form.  So a series is cut into ranges of steps; inside a
    range the average has a closed form over window sums and minima; between
    ranges only one composed step per range is carried.  A series of any length
    is spread over many tasks.
    """
    # Powers of 1/decay stay below 1e6 inside a range.
    width = max(1, min(CHUNK_STEPS, int(math.log(1e6) / -math.log(decay))))
    rows = df.withColumn("_chunk", F.floor(F.col(step) / width).cast("long"))
    seeds = rows.filter(F.col(loss) != 0).groupBy(series, "_chunk").agg(F.min(step).alias("_seed"))
    firsts = seeds.groupBy(series).agg(F.min("_seed").alias("_seed")).withColumn(
        "_chunk", F.floor(F.col("_seed") / width).cast("long"))
    if start is None:
        start = df.sparkSession.createDataFrame([], df.select(series, F.lit(0.0).alias("running_avg")).schema)
    given = start.select(series, F.col("running_avg").alias("_given")).filter("_given <> 0")
    firsts = firsts.join(given, series, "left_anti")
    inside = Window.partitionBy(series, "_chunk").orderBy(step)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    gain = F.when(F.col(step) == F.col("_seed"), F.col(loss)).otherwise((1 - decay) * F.col(loss))
    scaled = (
        rows.join(firsts, [series, "_chunk"], "left")
        .withColumn("_k", F.row_number().over(inside))
        .withColumn("_p", F.sum(gain * F.pow(F.lit(decay), -F.col("_k"))).over(upto))
        .withColumn("_m", F.min(clip * F.pow(F.lit(decay), -F.col("_k")) - F.col("_p")).over(upto))
    )
    last = F.max_by(F.struct("_k", "_p", "_m"), F.col("_k"))
    power = F.pow(F.lit(decay), F.col("_l._k"))
    chunks = scaled.groupBy(series, "_chunk").agg(last.alias("_l")).select(
        series, "_chunk", F.floor(F.col("_chunk") / CHUNKS_PER_BLOCK).alias("_block"),
        power.alias("a"), (power * F.col("_l._p")).alias("b"),
        (power * (F.col("_l._p") + F.col("_l._m"))).alias("c"))
    cells = lambda place: F.array_sort(F.collect_list(F.struct(place, "a", "b", "c")))
    blocks = chunks.groupBy(series, "_block").agg(cells("_chunk").alias("_cells"))
    starts = (
        blocks.select(series, "_block", _compose(F.col("_cells")).alias("_f"))
        .select(series, "_block", "_f.*")
        .groupBy(series).agg(cells("_block").alias("_blocks")).join(given, series, "left")
        .withColumn("_before", _carry_state(F.coalesce("_given", F.lit(0.0)), F.col("_blocks")))
        .select(series, F.explode(F.arrays_zip(
            F.col("_blocks._block").alias("_block"), F.col("_before").alias("_start"))).alias("_z"))
        .select(series, "_z._block", "_z._start")
    )
    carried = (
        blocks.join(starts, [series, "_block"])
        .withColumn("_before", _carry_state(F.col("_start"), F.col("_cells")))
        .select(series, F.explode(F.arrays_zip(
            F.col("_cells._chunk").alias("_chunk"), F.col("_before").alias("_x"))).alias("_z"))
        .select(series, "_z._chunk", "_z._x")
    )
    average = F.pow(F.lit(decay), F.col("_k")) * (
        F.col("_p") + F.least(F.col("_x"), F.col("_m")))
    return scaled.join(carried, [series, "_chunk"]).withColumn("running_avg", average).drop(
        "_chunk", "_seed", "_k", "_p", "_m", "_x")


def best_so_far(df: DataFrame, series: str, step: str, value: str, start: DataFrame | None = None) -> DataFrame:
    """Add ``is_best``: the value is strictly below all earlier ones of its series.

    ``start (series, best)`` has the lowest values that series come with, one row each.
    """
    rows = df.withColumn("_chunk", F.floor(F.col(step) / CHUNK_STEPS).cast("long"))
    earlier = Window.partitionBy(series).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    before = rows.groupBy(series, "_chunk").agg(F.min(value).alias("_low")).select(
        series, "_chunk", F.min("_low").over(earlier).alias("_before"))
    if start is not None:
        given = start.select(series, F.col("best").alias("_given"))
        before = before.join(given, series, "left").select(series, "_chunk", F.least("_before", "_given").alias("_before"))
    inside = Window.partitionBy(series, "_chunk").orderBy(step).rowsBetween(
        Window.unboundedPreceding, -1)
    low = F.least("_before", "_inner")  # ignores nulls
    return (
        rows.withColumn("_inner", F.min(value).over(inside))
        .join(before, [series, "_chunk"])
        .withColumn("is_best", low.isNull() | (F.col(value) < low))
        .drop("_chunk", "_inner", "_before")
    )


def finite_audit(df: DataFrame, group: str, value: str) -> DataFrame:
    """``(group, verdict)``: finite, all_nonfinite or some_nonfinite."""
    ok = is_finite(F.col(value))
    return df.groupBy(group).agg(F.bool_and(ok).alias("_all"), F.bool_or(ok).alias("_any")).select(
        group, F.when(F.col("_all"), "finite").when(F.col("_any"), "some_nonfinite")
        .otherwise("all_nonfinite").alias("verdict"))


def audit_passed(audit: DataFrame) -> DataFrame:
    return audit.agg(F.bool_and(F.col("verdict") == "finite").alias("passed"))


def coverage_losses(attention: DataFrame, example: str, step: str, position: str,
                    weight: str) -> DataFrame:
    """``(example, step, covloss)``: attention spent again on covered positions."""
    covered = sum_before(attention, weight, step, (example, position), "_coverage")
    return covered.groupBy(example, step).agg(
        F.sum(F.least(weight, "_coverage")).alias("covloss"))


def masked_mean(df: DataFrame, example: str, value: str, mask: str) -> DataFrame:
    """Mean over examples of the mean over an example's unmasked steps."""
    per_example = df.groupBy(example).agg(
        (F.sum(F.col(value) * F.col(mask)) / F.sum(mask)).alias("_mean"))
    return per_example.agg(F.avg("_mean").alias("mean"))
