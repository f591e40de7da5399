"""Array functions for encoded sequences and vectors, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import PAD_ID, START_ID, STOP_ID


def pin(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row.

    The optimizer would inline an expression into a lambda that refers to it and
    evaluate it again for every element; a one-row generator stops that.
    """
    cell = F.struct(*[c.alias(name) for name, c in columns.items()])
    rest = [c for c in df.columns if c not in columns]
    return df.withColumn("_pin", F.explode(F.array(cell))).select(*rest, "_pin.*")


def pad(array: Column, length: Column, value: int = PAD_ID) -> Column:
    """Extend an int array to ``length`` with the padding id."""
    missing = F.greatest(length - F.size(array), F.lit(0)).cast("int")
    return F.concat(array, F.array_repeat(F.lit(value), missing))


def mask(used: Column, length: Column) -> Column:
    """1 for the first ``used`` positions of ``length``, else 0."""
    used = F.least(used, length).cast("int")
    return F.concat(
        F.array_repeat(F.lit(1), used),
        F.array_repeat(F.lit(0), (length - used).cast("int")),
    )


def decoder_input(ids: Column, max_len: int) -> Column:
    return F.slice(F.concat(F.array(F.lit(START_ID)), ids), 1, max_len)


def decoder_target(ids: Column, max_len: int) -> Column:
    """Ids plus the stop id; no stop id when the sequence was cut."""
    return F.slice(F.concat(ids, F.array(F.lit(STOP_ID))), 1, max_len)


def total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x)


def vector_sum(vectors: Column, dim: int) -> Column:
    """Element-wise sum of an array of double vectors of width ``dim``."""
    zero = F.array_repeat(F.lit(0.0), dim)
    return F.aggregate(
        vectors, zero, lambda acc, v: F.zip_with(acc, v, lambda a, b: a + b)
    )


def with_unit(df: DataFrame, name: str, vector: Column) -> DataFrame:
    """Add an L2-normalised vector; a zero vector stays zero."""
    df = pin(df, **{name: vector})
    square = F.aggregate(name, F.lit(0.0), lambda acc, x: acc + x * x)
    df = pin(df, _norm=F.sqrt(square))
    return df.withColumn(name, F.when(F.col("_norm") == 0, F.col(name)).otherwise(
        F.transform(name, lambda x: x / F.col("_norm")))).drop("_norm")
