"""Row numbering and running sums that never sort one group in one task.

Order is cut into ranges.  Each range is sorted on its own, and the small table
of range totals supplies what came before, so a group that owns a third of the
data is spread over as many tasks as it has ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut


def _range(key: str, width: int) -> Column:
    return F.floor(F.col(key) / F.lit(width)).cast("long")


def number_rows(df: DataFrame, key: str | Sequence[Column | str], group: Sequence[str] = (),
                name: str = "row_index") -> DataFrame:
    """Add a 0-based dense position by ``key`` (one column or several orders) inside ``group``.

    One range-partitioned sort, written once; its partitions are counted, and each row
    adds the rows of the partitions before its own.  Keys may be of any kind, sparse or
    repeated, and a group may hold any share of the rows.
    """
    orders = [key] if isinstance(key, str) else list(key)
    # the upper bits of the running id are the partition, the lower 33 the place in it
    placed = cut(df.orderBy(*group, *orders).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(part).agg(F.count("*").alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    # one row per partition of the sort
    numbered = (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
                .withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
                .drop("_part", "_at", "_before"))
    if not group:
        return numbered
    first = numbered.groupBy(*group).agg(F.min(name).alias("_first"))
    return numbered.join(first, list(group)).withColumn(name, F.col(name) - F.col("_first")).drop("_first")


def sum_before(df: DataFrame, value: str, key: str, group: tuple[str, ...],
               name: str, width: int = 1_000) -> DataFrame:
    """Add the sum of ``value`` over the group's rows with a smaller ``key``."""
    cells = df.withColumn("_range", _range(key, width))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (
        cells.groupBy(*group, "_range").agg(F.sum(value).alias("_sum"))
        .withColumn("_carry", F.coalesce(F.sum("_sum").over(earlier), F.lit(0.0)))
        .drop("_sum")
    )
    inside = Window.partitionBy(*group, "_range").orderBy(key).rowsBetween(
        Window.unboundedPreceding, -1)
    return (
        cells.withColumn("_inner", F.coalesce(F.sum(value).over(inside), F.lit(0.0)))
        .join(offsets, [*group, "_range"])
        .withColumn(name, F.col("_carry") + F.col("_inner"))
        .drop("_range", "_carry", "_inner")
    )
