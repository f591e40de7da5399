"""Connected components of a graph given as edges between long ids."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut

#: Edges (24 MB of numbers) that one task may finish; larger graphs are contracted first.
TASK_EDGES = 500_000


def components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; equal root, same component.

    Each round every node moves to the node of its closed neighbourhood that comes first
    in a random order of the round, and the edges between the places moved to are all
    that remain: expected, the graph shrinks by a constant factor, whatever its shape.
    Once few enough edges are left to be read by one task, that task ends the work.
    Then the moves are followed from the last round back to the first.  Loops and
    repeated edges do no harm; an edge with a null end is left out; no edges, no rows.
    """
    rest = cut(_normal(edges.select("a", "b")))
    moves: list[DataFrame] = []
    while rest.count() > task_edges:
        turn = len(moves)
        both = rest.union(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = F.min_by("b", F.xxhash64("b", F.lit(turn)))
        moves.append(cut(
            both.groupBy("a").agg(first.alias("b"))
            .select(F.col("a").alias("node"),
                    F.when(F.xxhash64("a", F.lit(turn)) < F.xxhash64("b", F.lit(turn)), F.col("a"))
                    .otherwise(F.col("b")).alias("root"))))
        left, right = (moves[-1].select(F.col("node").alias(n), F.col("root").alias(f"_{n}")) for n in "ab")
        rest = cut(_normal(rest.join(left, "a").join(right, "b")
                           .select(F.col("_a").alias("a"), F.col("_b").alias("b"))))
    roots = rest.coalesce(1).mapInArrow(_forest, "node bigint, root bigint")
    for move in reversed(moves):
        ahead = cut(roots).select(F.col("node").alias("root"), F.col("root").alias("_root"))
        roots = move.join(ahead, "root", "left").select("node", F.coalesce("_root", "root").alias("root"))
    return roots


def _normal(edges: DataFrame) -> DataFrame:
    return (edges.filter(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _forest(batches):
    """Union-find over all edges of the task: every node with the smallest of its component."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([find(n) for n in nodes], pa.int64())],
        names=["node", "root"])
