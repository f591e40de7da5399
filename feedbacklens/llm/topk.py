"""Exact top-k search by inner product with a pivot table.

Inner products become distances: with one more coordinate, ``sqrt(M^2 - |v|^2)`` for a
candidate and 0 for a query, ``|q - v|^2 = |q|^2 + M^2 - 2 q.v``.  Distances to pivots,
stored once per row, bound that distance from below for every pair; candidates are
evaluated in the order of their bounds, until the next bound cannot beat the k-th best.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut
from .columns import column
from .vectors import matrix, sample_rows, usable, widened

PIVOTS, SAMPLE = 64, 2048
QUERY_ROWS, CANDIDATE_ROWS = 1024, 4096
#: Relative error granted to a stored distance (single precision).
SLACK = 1e-6
STEP = 64
FOUND = "query long, query_key long, candidate_key long, score long"


def _spread_out(rows: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other: each next one is the farthest from those before."""
    far = ((rows - rows.mean(axis=0)) ** 2).sum(axis=1)
    chosen = []
    for _ in range(min(count, len(rows))):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return rows[chosen]


class PivotTable:
    """Pivots, and the seed candidates that give every query a first k-th score."""

    def __init__(self, sample: np.ndarray, top: int):
        self.width = sample.shape[1]
        self.sample = sample
        self.pivots = _spread_out(sample.astype(float), PIVOTS)
        self.square = float(top)
        self.lifted = np.sqrt(np.maximum(self.square - (self.pivots ** 2).sum(axis=1), 0))

    def _both(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, pivots = rows.astype(float), self.pivots
        width = max(rows.shape[1], pivots.shape[1])
        return widened(rows, width), widened(pivots, width)

    def of_candidates(self, rows: np.ndarray) -> np.ndarray:
        rows, pivots = self._both(rows)
        norms = (rows ** 2).sum(axis=1)
        lift = np.sqrt(np.maximum(self.square - norms, 0))
        squares = 2 * (self.square - rows @ pivots.T - lift[:, None] * self.lifted)
        return np.sqrt(np.maximum(squares, 0)).astype(np.float32)

    def of_queries(self, rows: np.ndarray) -> np.ndarray:
        rows, pivots = self._both(rows)
        squares = (rows ** 2).sum(axis=1)[:, None] + self.square - 2 * (rows @ pivots.T)
        return np.sqrt(np.maximum(squares, 0)).astype(np.float32)


def search_block(queries: np.ndarray, query_far: np.ndarray, candidates: np.ndarray,
                 far: np.ndarray, own: list[np.ndarray], first: np.ndarray, ids: np.ndarray,
                 square: float, k: int) -> list[tuple[int, int, int]]:
    """``(query, candidate, score)`` of all that can be among a query's k best of the block.

    ``own[i]`` are the positions of query ``i`` itself, ``first[i]`` a score that its k-th
    best reaches at least.
    """
    slack = SLACK * float(max(query_far.max(initial=0), far.max(initial=0), 1.0))
    found = []
    for i, query in enumerate(queries):
        low = np.abs(far - query_far[i]).max(axis=1).astype(float) - slack
        norm = float((query.astype(float) ** 2).sum())
        bound = (norm + square - np.square(np.maximum(low, 0))) / 2 + 1e-9 * (norm + square)
        bound[own[i]] = -np.inf
        open_ = np.flatnonzero(bound >= first[i])
        open_ = open_[np.argsort(-bound[open_], kind="stable")]
        limit, best = first[i], []
        for at in range(0, len(open_), STEP):
            if bound[open_[at]] < limit:
                break
            some = open_[at:at + STEP]
            best += zip((-(candidates[some] @ query)).tolist(), ids[some].tolist(), some.tolist())
            best = sorted(best)[:k]
            if len(best) == k:
                limit = max(limit, -best[-1][0])
        found += [(i, position, -score) for score, _, position in best if -score >= first[i]]
    return found


def top_k(rows: DataFrame, is_query: Column, *, key: str = "vec_id", vector: str = "embedding",
          k: int = 5, scale: int = 256) -> DataFrame:
    """``query_id, rank, <key>, score``: each query's ``k`` best other rows, all if fewer.

    Components become ``floor(scale * x)``; the score is their integer inner product,
    which must fit a long.  Ties go to the smaller key.  Vectors that are null, empty or
    hold null or non-finite components, and rows without a key, take no part; shorter
    vectors are filled up with zeros.  A repeated row is a row of its own: it is found
    beside its twin and asked for itself.  An empty table gives no rows.

    Queries and candidates are dealt into blocks; each pair of blocks is one bounded
    group.  Only ``SAMPLE`` rows reach the driver, for pivots and first scores.
    """
    base = rows.select(column(key).alias("key"), column(vector).alias("vec"),
                       F.coalesce(is_query, F.lit(False)).alias("asks"))
    whole = F.transform("vec", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    ready = cut(base.filter(usable(F.col("vec")) & F.col("key").isNotNull())
                .select("key", "asks", whole.alias("vec"), F.monotonically_increasing_id().alias("uid"))
                .withColumn("square", F.aggregate("vec", F.lit(0).cast("long"), lambda a, x: a + x * x)))
    total, asking, top = ready.agg(F.count("*"), F.count_if("asks"), F.max("square")).first()
    spark = rows.sparkSession
    if not asking:
        return spark.createDataFrame([], f"query_id long, rank int, `{key}` long, score long")
    sample = sample_rows(ready, "uid", "vec", SAMPLE)
    seeds = sample.column("uid").to_numpy()
    pivots = spark.sparkContext.broadcast(PivotTable(matrix(sample.column("vec"), np.int64), top))

    def measure(batches, queries):
        for batch in batches:
            table = pivots.value
            vectors = matrix(batch.column("vec"), np.int64)
            far = table.of_queries(vectors) if queries else table.of_candidates(vectors)
            out = [batch.column("uid"), batch.column("key"), batch.column("vec"),
                   pa.array([row.tobytes() for row in far], pa.binary())]
            if queries:
                width = max(vectors.shape[1], table.width)
                scores = widened(vectors, width) @ widened(table.sample, width).T
                scores[batch.column("uid").to_numpy()[:, None] == seeds[None, :]] = np.iinfo(np.int64).min
                scores = np.sort(scores, axis=1)[:, -k] if scores.shape[1] >= k else np.full(
                    len(vectors), np.iinfo(np.int64).min)
                out.append(pa.array(scores, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                out, names=["uid", "key", "vec", "far", "first"][:len(out)])

    columns = "uid long, key long, vec array<long>, far binary"
    n_c, n_q = -(-total // CANDIDATE_ROWS), -(-asking // QUERY_ROWS)
    candidates = ready.select("uid", "key", "vec").mapInArrow(lambda b: measure(b, False), columns)
    queries = ready.filter("asks").select("uid", "key", "vec").mapInArrow(
        lambda b: measure(b, True), columns + ", first long")
    block = F.pmod(F.xxhash64("uid"), F.lit(n_c)).cast("int").alias("c"), F.explode(
        F.sequence(F.lit(0), F.lit(n_q - 1))).alias("q")
    candidates = candidates.select("*", *block)
    queries = queries.select("*", F.pmod(F.xxhash64("uid"), F.lit(n_q)).cast("int").alias("q"),
                             F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))).alias("c"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, asked = matrix(right.column("vec"), np.int64), matrix(left.column("vec"), np.int64)
        width = max(rows.shape[1], asked.shape[1])
        ids, keys = right.column("uid").to_numpy(), right.column("key").to_numpy()
        askers, their = left.column("uid").to_numpy(), left.column("key").to_numpy()
        far, query_far = (np.frombuffer(b"".join(t.column("far").to_pylist()), np.float32).reshape(len(t), -1)
                          for t in (right, left))
        found = search_block(widened(asked, width), query_far, widened(rows, width), far,
                             [np.flatnonzero(ids == a) for a in askers], left.column("first").to_numpy(),
                             keys, pivots.value.square, k)
        q, c, s = zip(*found) if found else ((), (), ())
        q, c = np.array(q, np.int64), np.array(c, np.int64)
        return pa.table({"query": askers[q], "query_key": their[q], "candidate_key": keys[c],
                         "score": pa.array(s, pa.int64())})

    near = queries.groupBy("c", "q").cogroup(candidates.groupBy("c", "q")).applyInArrow(search, FOUND)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "candidate_key")
    return (near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(F.col("query_key").alias("query_id"), "rank",
                    F.col("candidate_key").alias(key), "score"))
