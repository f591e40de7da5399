"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in at most ``radius`` bits exactly if some value lies within
half the radius of both.  So every distinct fingerprint is sent to all values within
half the radius (65 for radius 2), and those that meet are neighbours.  A value is met
by at most as many distinct fingerprints as there are values around it, so no group
grows with the data; members are tied to the smallest one, not to each other.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut, small_side
from .columns import column, unused
from .components import components

BITS, SEED, BLOCK = 64, 42, 1 << 14


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of the word shingles of one text, as a signed 64-bit number.

    A-Z are lower-cased, words end at ASCII white space.  A text of fewer words is one
    shingle; null, empty or blank texts have fingerprint zero.
    """
    from xxhash import xxh64_intdigest

    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        starts, ends = [0], [len(joined)]
    else:
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        after = np.cumsum(sizes + 1) - 1
        starts, ends = (after - sizes)[:1 - words or None].tolist(), after[words - 1:].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), BLOCK):
        hashes = np.array([xxh64_intdigest(joined[s:e], SEED)
                           for s, e in zip(starts[at:at + BLOCK], ends[at:at + BLOCK])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = 3, out: str = "fingerprint") -> DataFrame:
    """Add the long column ``out`` (replaced if present); see ``fingerprint`` for odd texts."""
    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py(), words) for t in texts], pa.int64())

    return docs.withColumn(out, simhash(column(text)))


def ball(radius: int) -> list[int]:
    """All bit masks with at most ``radius`` bits set, as signed longs."""
    masks = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(BITS), k)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def near_edges(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Edges ``(a, b)`` that connect all of ``distinct (fp)`` within ``radius`` bits.

    Where fingerprints meet, each is tied to the smallest: that keeps every component
    whole with fewer edges than members.  Each edge is checked against the radius.
    """
    if radius % 2:
        raise ValueError("the radius must be even: members of a ball are then all linked")
    masks = F.array(*[F.lit(m) for m in ball(radius // 2)])
    sent = (distinct.select("fp", F.explode(masks).alias("mask"))
            .select(F.col("fp").bitwiseXOR(F.col("mask")).alias("value"), "fp"))
    met = sent.select("fp", F.min("fp").over(Window.partitionBy("value")).alias("low"))
    return (met.filter((F.col("fp") != F.col("low"))
                       & (F.bit_count(F.col("fp").bitwiseXOR(F.col("low"))) <= radius))
            .select(F.col("low").alias("a"), F.col("fp").alias("b")).distinct())


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                    radius: int = 2, words: int = 3) -> DataFrame:
    """``(key, fp, component)``: one row per document, ``component`` its smallest key reachable.

    Equal fingerprints are folded before any pair is looked for, so groups of copies cost
    nothing; the largest of them meets its component by a join that adaptive execution
    splits.  Null, empty and blank texts share fingerprint zero and are linked by it.  A
    null key stays in its row but names no component (null only if no key is known
    there); repeated rows give repeated results; an empty table gives none.
    """
    prints = cut(with_fingerprint(
        docs.select(column(key).alias("key"), column(text).alias("text")), "text", words, "fp")
        .select("key", "fp"))
    folded = cut(prints.groupBy("fp").agg(F.min("key").alias("low")))
    linked = cut(components(near_edges(folded.select("fp"), radius)))
    placed = cut(folded.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
                 .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    named = placed.groupBy("root").agg(F.min("low").alias("component"))
    named = cut(placed.join(named, "root").select("fp", "component"))
    return (prints.join(named, "fp")
            .select(F.col("key").alias(key), "fp", "component"))


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                radius: int = 2, words: int = 3) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest key, a null key last.

    Rows that share the smallest key are told apart by their text, and rows that repeat key
    and text give one row.  Null, empty and blank texts are one group; very long texts are
    compared whole; an empty table stays empty; columns of any other name are kept.
    """
    own, place = unused(docs, "_place"), F.struct(
        column(key).isNull().alias("none"), column(key).alias("key"), F.xxhash64(column(text)).alias("text"))
    placed = docs.withColumn(own, place)
    found = cut(near_duplicates(placed.select(own, column(text)), key=own, text=text, radius=radius, words=words))
    gone = cut(found.filter(F.col(own) != F.col("component")).select(own).distinct())
    repeated = cut(found.filter(F.col(own) == F.col("component")).groupBy(own).agg(F.count("*").alias("n"))
                   .filter("n > 1").select(own))
    rest = placed.join(small_side(gone), own, "left_anti")
    if repeated.isEmpty():
        return rest.drop(own)
    once = rest.join(small_side(repeated), own, "left_semi").dropDuplicates([own])
    return rest.join(small_side(repeated), own, "left_anti").unionByName(once).drop(own)


def hex_digits(fp: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
