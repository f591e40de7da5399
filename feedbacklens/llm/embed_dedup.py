"""Embedding near-duplicates by an epsilon grid order join.

Vectors of a label, scaled to length one, are sorted by the cells (of width epsilon)
of their leading principal coordinates.  Runs of the sorted sequence become blocks; two
blocks are joined unless their boxes are farther apart than epsilon, and a join splits
both runs again and again, skipping distant halves, until few vectors are left.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import cut
from .columns import column
from .components import components
from .vectors import matrix, sample_rows, usable, widened

DIMENSIONS, SAMPLE = 6, 4096
BLOCK_ROWS, LEAF_ROWS = 1024, 128
BLOCKS = ("label int, block long, low array<double>, high array<double>, rows int, width int, "
          "ids binary, copies binary, spot binary, vectors binary")


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision; scaled twice against overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def principal(rows: np.ndarray, count: int) -> np.ndarray:
    """Leading principal directions, as columns."""
    centred = rows - rows.mean(axis=0)
    return np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :count]


def gap(low_a, high_a, low_b, high_b) -> float:
    """Squared distance of two boxes: no two of their members are nearer."""
    apart = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return float((apart * apart).sum())


class GridJoin:
    """Joins two runs of the sorted sequence by halves."""

    def __init__(self, a: dict, b: dict, cosine: float):
        self.a, self.b, self.cosine = a, b, cosine
        self.reach = 2 - 2 * cosine + 1e-9
        self.links_a = np.zeros(len(a["ids"]), np.int64)
        self.links_b = self.links_a if a is b else np.zeros(len(b["ids"]), np.int64)
        self.edges: set[tuple[int, int]] = set()

    def run(self, a0: int, a1: int, b0: int, b1: int) -> None:
        spot_a, spot_b = self.a["spot"][a0:a1], self.b["spot"][b0:b1]
        if gap(spot_a.min(0), spot_a.max(0), spot_b.min(0), spot_b.max(0)) > self.reach:
            return
        if a1 - a0 <= LEAF_ROWS and b1 - b0 <= LEAF_ROWS:
            return self.leaf(a0, a1, b0, b1)
        halves = [[(s, e)] if e - s <= LEAF_ROWS else [(s, (s + e) // 2), ((s + e) // 2, e)]
                  for s, e in ((a0, a1), (b0, b1))]
        same = self.a is self.b
        for s, e in halves[0]:
            for t, u in halves[1]:
                if not same or s <= t:
                    self.run(s, e, t, u)

    def leaf(self, a0: int, a1: int, b0: int, b1: int) -> None:
        near = self.a["vectors"][a0:a1] @ self.b["vectors"][b0:b1].T >= self.cosine
        own = self.a is self.b and a0 == b0
        if own:
            np.fill_diagonal(near, False)
        if not near.any():
            return
        self.links_a[a0:a1] += near @ self.b["copies"][b0:b1]
        if not own:
            self.links_b[b0:b1] += near.T @ self.a["copies"][a0:a1]
        # one tie to the smallest member of each part of the leaf keeps the parts whole
        left, right = self.a["ids"][a0:a1], self.b["ids"][b0:b1]
        none = np.iinfo(np.int64).max
        name_a, name_b = left.copy(), right.copy()
        while True:
            new_a = np.minimum(name_a, np.where(near, name_b[None, :], none).min(axis=1))
            new_b = np.minimum(name_b, np.where(near, new_a[:, None], none).min(axis=0))
            if (new_a == name_a).all() and (new_b == name_b).all():
                break
            name_a, name_b = new_a, new_b
        self.edges.update((r, n) for names, ids in ((name_a, left), (name_b, right))
                          for r, n in zip(names.tolist(), ids.tolist()) if r != n)


def _unpack(row: dict, side: str) -> dict:
    n, width = row[f"rows{side}"], row[f"width{side}"]
    take = lambda name, kind, shape: np.frombuffer(row[name + side], kind).reshape(shape)
    return {"ids": take("ids", np.int64, n), "copies": take("copies", np.int64, n),
            "spot": take("spot", np.float32, (n, -1)).astype(float),
            "vectors": unit_rows(take("vectors", np.float64, (n, width)))}


def near_duplicates(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding",
                    label: str = "label", cosine: float = 0.93) -> DataFrame:
    """``key, n_links, component_id, kept`` for every row.

    Rows are linked where their labels are equal and the cosine in double precision is at
    least ``cosine`` (above 0).  Null, empty or zero vectors, those with null or
    non-finite components, and rows without a label link with nothing and stand alone.
    Copies of a vector are folded before the join and counted in ``n_links``; repeated
    rows are rows of their own.  Vectors of different lengths are compared as if filled up
    with zeros.  A null key stays in its row and names no component; an empty table gives
    no rows.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and at most 1")
    spark = rows.sparkSession
    base = cut(rows.select(column(key).alias("key"), column(label).cast("int").alias("label"),
                           column(vector).alias("vec"), F.monotonically_increasing_id().alias("uid")))
    real = base.filter(usable(F.col("vec")) & F.col("label").isNotNull()
                       & F.exists("vec", lambda x: x != 0))
    folded = cut(real.groupBy("label", "vec").agg(
        F.min("uid").alias("uid"), F.min("key").alias("low"), F.count("*").alias("copies")))
    sample = sample_rows(folded, "uid", "vec", SAMPLE)
    if not sample.num_rows:
        return base.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"),
                           F.col("key").alias("component_id"), F.lit(True).alias("kept"))
    axes = spark.sparkContext.broadcast(
        principal(unit_rows(matrix(sample.column("vec"), float)), DIMENSIONS))
    reach = math.sqrt(2 - 2 * cosine) + 1e-9

    @F.arrow_udf("array<float>")
    def place(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.list_(pa.float32()))
        units, directions = unit_rows(matrix(vectors, float)), axes.value
        width = min(units.shape[1], len(directions))  # longer tails only add to distances
        spots = units[:, :width] @ directions[:width]
        return pa.array(spots.astype(np.float32).tolist(), pa.list_(pa.float32()))

    cells = [F.floor(F.get("spot", F.lit(i)) / reach) for i in range(min(DIMENSIONS, axes.value.shape[1]))]
    ordered = cut(folded.withColumn("spot", place("vec")).withColumn("cell", F.array(*cells)))
    runs = max(1, -(-ordered.count() // (8 * BLOCK_ROWS)))
    ordered = (ordered.repartitionByRange(runs, "label", "cell", "uid")
               .sortWithinPartitions("label", "cell", "uid"))
    blocks = cut(ordered.select("label", "uid", "copies", "spot", "vec").mapInArrow(_blocks, BLOCKS))

    meta = blocks.select("label", "block", "low", "high")
    cell = lambda name, more: F.floor(F.get(name, F.lit(0)) / reach) + more
    left = meta.select("label", F.col("block").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"),
                       F.explode(F.sequence(cell("low", -1), cell("high", 1))).alias("cell"))
    right = meta.select("label", F.col("block").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"),
                        F.explode(F.sequence(cell("low", 0), cell("high", 0))).alias("cell"))
    apart = F.zip_with(
        F.zip_with("low_a", "high_b", lambda x, y: x - y), F.zip_with("low_b", "high_a", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)))
    square = F.aggregate(apart, F.lit(0.0), lambda s, x: s + x * x)
    # single-precision coordinates: a little more than the reach, so that no pair is missed
    pairs = cut(left.join(right, ["label", "cell"])
                .filter((F.col("a") <= F.col("b")) & (square <= reach * reach + 1e-5))
                .select("a", "b").distinct())
    packed = blocks.drop("label", "low", "high")
    side = lambda s: packed.select(
        F.col("block").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in packed.columns if c != "block"])

    def join_blocks(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                a = _unpack(row, "_a")
                b = a if row["a"] == row["b"] else _unpack(row, "_b")
                width = max(a["vectors"].shape[1], b["vectors"].shape[1])
                for part in (a, b):
                    part["vectors"] = widened(part["vectors"], width)
                work = GridJoin(a, b, cosine)
                work.reach += 1e-5
                work.run(0, len(a["ids"]), 0, len(b["ids"]))
                sides = [(a, work.links_a)] if a is b else [(a, work.links_a), (b, work.links_b)]
                ids = [part["ids"][links > 0] for part, links in sides]
                counts = [links[links > 0] for _, links in sides]
                edges = np.array(sorted(work.edges), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([*ids, edges[:, 1]])),
                    pa.array(np.concatenate([*counts, np.zeros(len(edges), np.int64)])),
                    pa.array([None] * sum(map(len, ids)) + edges[:, 0].tolist(), pa.int64())],
                    names=["uid", "links", "root"])

    found = cut(pairs.join(side("a"), "a").join(side("b"), "b")
                .mapInArrow(join_blocks, "uid long, links long, root long"))
    counts = found.groupBy("uid").agg(F.sum("links").alias("links"))
    roots = components(found.filter("root IS NOT NULL").select(F.col("root").alias("a"), F.col("uid").alias("b")))
    placed = cut(folded.join(counts, "uid", "left").join(roots.withColumnRenamed("node", "uid"), "uid", "left")
                 .select("label", "vec", "low", F.coalesce("root", "uid").alias("root"),
                         (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    named = placed.groupBy("root").agg(F.min("low").alias("component"))
    named = cut(placed.join(named, "root").select("label", "vec", "n_links", "component"))
    alone = base.join(real.select("uid"), "uid", "left_anti").select(
        "key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return (real.join(named, ["label", "vec"]).select("key", "n_links", F.col("component").alias("component_id"))
            .union(alone)
            .select(F.col("key").alias(key), "n_links", "component_id",
                    F.col("key").eqNullSafe(F.col("component_id")).alias("kept")))


def _blocks(batches):
    """Cut a sorted partition into runs of one label and at most ``BLOCK_ROWS`` rows."""
    made, held = 0, None

    def pack(table: pa.Table, number: int) -> pa.RecordBatch:
        spot = matrix(table.column("spot"), np.float32)
        vectors = matrix(table.column("vec"), float)
        values = [table.column("label")[0].as_py(), (TaskContext.get().partitionId() << 32) + number,
                  spot.min(axis=0).astype(float).tolist(), spot.max(axis=0).astype(float).tolist(),
                  len(table), vectors.shape[1], table.column("uid").to_numpy().tobytes(),
                  table.column("copies").to_numpy().tobytes(), spot.tobytes(), vectors.tobytes()]
        schema = pa.schema([("label", pa.int32()), ("block", pa.int64()), ("low", pa.list_(pa.float64())),
                            ("high", pa.list_(pa.float64())), ("rows", pa.int32()), ("width", pa.int32()),
                            *[(c, pa.binary()) for c in ("ids", "copies", "spot", "vectors")]])
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        while len(held):
            labels = held.column("label").to_numpy()
            same = int(np.argmax(labels != labels[0])) if (labels != labels[0]).any() else len(labels)
            if same == len(labels) and same < BLOCK_ROWS:
                break  # the run may go on in the next batch
            size = min(same, BLOCK_ROWS)
            yield pack(held.slice(0, size), made)
            made, held = made + 1, held.slice(size)
    if held is not None and len(held):
        yield pack(held, made)
