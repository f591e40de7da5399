"""Endless passes over records, each in another order, as a stream.

The stream counts places; a place and the number of its pass give the record to read by a
keyed permutation, so no order is ever stored, and the offset in the stream's checkpoint
says in which pass and at which place to go on after a restart.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROUNDS = 4


def grid(records: int) -> tuple[int, int]:
    """Sides of the smallest near-square grid with a cell for each record; its cells are a pass's places."""
    if records < 1:
        raise ValueError("a pass needs records")
    width = isqrt(records - 1) + 1
    return -(-records // width), width


def record_at(turn: Column, place: Column, records: int, seed: int = 1) -> Column:
    """The record read at a place of a pass; from ``records`` on, the place is blank.

    Row and column of a place are shifted by turns, each by a hash of the other: every
    shift can be undone, so every record has one place in every pass.
    """
    high, width = grid(records)
    row, column = F.floor(place / F.lit(width)).cast("long"), F.pmod(place, F.lit(width))
    for step in range(ROUNDS):
        shift = lambda of: F.xxhash64(turn, of, F.lit(step), F.lit(seed))  # noqa: B023, E731
        if step % 2:
            column = F.pmod(column + F.pmod(shift(row), F.lit(width)), F.lit(width))
        else:
            row = F.pmod(row + F.pmod(shift(column), F.lit(high)), F.lit(high))
    return row * width + column


def endless_passes(spark: SparkSession, records: DataFrame, count: int, per_batch: int, number: str = "record",
                   seed: int = 1, partitions: int | None = None) -> DataFrame:
    """A stream of ``records``, whose column ``number`` runs from 0 to ``count`` - 1, without end.

    Adds ``pass`` and ``place``; inside a pass records are to be read in the order of
    ``place``.  Every pass holds every record once.  A micro-batch takes ``per_batch``
    places and reads the table once, so it should be a fair share of a pass.
    """
    high, width = grid(count)
    clock = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", per_batch)
             .option("numPartitions", partitions or spark.sparkContext.defaultParallelism)
             .option("startTimestamp", 0).option("advanceMillisPerBatch", 1_000).load())
    turn, place = F.floor(F.col("value") / F.lit(high * width)).cast("long"), F.pmod("value", F.lit(high * width))
    places = clock.select(turn.alias("pass"), place.alias("place"))
    return places.withColumn(number, record_at(F.col("pass"), F.col("place"), count, seed)).join(records, number)


def run_batch(stream: DataFrame, out: str) -> None:
    """Append the next micro-batch to Parquet files, exactly once; each call goes on where the last ended."""
    (stream.writeStream.format("parquet").outputMode("append")
     .option("checkpointLocation", out + "-progress").option("path", out)
     .trigger(availableNow=True).start().awaitTermination())
