"""Helpers shared by the two operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BIG = 1e300


def usable(vector: Column) -> Column:
    """Not null, not empty, and without null or non-finite components."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < BIG))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & whole, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    """Rows of an array column as a matrix; shorter rows are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), kind)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def sample_rows(df: DataFrame, key: str, column: str, size: int) -> pa.Table:
    """``size`` rows, the same ones at every run: those whose hashed key is smallest."""
    return (df.select(key, column).orderBy(F.xxhash64(key), key).limit(size)).toArrow()
