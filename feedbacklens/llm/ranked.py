"""Ranked lexical search by range-maximum tables and best-first document intervals.

Documents are read twice.  The first pass counts documents, terms and, for the terms that
are asked for, the documents holding them; the weights follow.  In the second pass a task
builds shards of bounded size: for each term a posting list in key order with the impact
of every posting, and one sparse table of range maxima over all lists.  For an item, an
interval of documents is bounded by the sum of its terms' maxima there.  The interval with
the highest bound is split at the document of its largest impact, which is scored exactly,
until no interval can reach the ten best that the task has seen; short intervals are
scored as a whole.  What leaves a task is its best documents per item, nothing else.
"""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut
from .columns import column

#: Postings of a shard, and of an interval that is scored as a whole.
SHARD, LEAF = 1_000_000, 4_096
BLOCK_CHARS = 4_000_000
_CLASS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII; A-Z lower-cased."""
    return (text or "").encode().translate(_CLASS).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Shard:
    """Posting lists of some documents, in key order, with impacts and range maxima."""

    def __init__(self, names: list, lengths: list[int], doc: np.ndarray, term: np.ndarray,
                 weights: np.ndarray, documents: int, total: int):
        """``names`` ascend, null last; ``doc`` and ``term`` hold an entry per occurrence."""
        self.names, self.width = names, max(len(names), 1)
        # list by list, each in order of documents
        self.keys, times = np.unique(term * self.width + doc, return_counts=True)
        self.term, self.doc = np.divmod(self.keys, self.width)
        norm = np.array([25 + 75 * n * documents // max(total, 1) for n in lengths] or [25], np.int64)
        self.impact = weights[self.term] * (1_000_000_000 * times // (1000 * times + 8 * norm[self.doc]))
        self.starts = np.searchsorted(self.term, np.arange(len(weights) + 1))
        longest = int(np.diff(self.starts).max(initial=1))
        self.log = np.zeros(longest + 1, np.int64)
        for n in range(2, longest + 1):
            self.log[n] = self.log[n // 2] + 1
        best = np.arange(len(self.keys), dtype=np.int32)
        self.table = np.empty((int(self.log[longest]) + 1, len(best)), np.int32)
        self.table[0] = best
        for level in range(1, len(self.table)):
            # windows that cross into the next list are never asked for
            half, above = 1 << (level - 1), self.table[level - 1]
            right = np.concatenate([above[half:], above[len(above) - half:]]) if half < len(above) else above
            self.table[level] = np.where(self.impact[right] > self.impact[above], right, above)

    def order(self, doc: int) -> tuple:
        name = self.names[doc]
        return (name is None, 0 if name is None else name)

    def search(self, asked: np.ndarray, repeats: np.ndarray, best: list, limit: int, leaf: int = LEAF) -> int:
        """Merge an item's best documents here into ``best``: ascending ``(-score, no name, name)``.

        Returns the number of intervals that were split or scored.
        """
        heap, turn, opened = [], count(), 0
        impact, keys = self.impact, self.keys

        def hopeless(bound: int, first: int) -> bool:
            return len(best) == limit and (-bound, *self.order(first)) > best[-1]

        def offer(doc: int, score: int) -> None:
            if score > 0:
                insort(best, (-score, *self.order(doc)))
                del best[limit:]

        def push(lists: np.ndarray, times: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
            some = np.flatnonzero(right > left)
            if not len(some):
                return
            lists, times, left, right = lists[some], times[some], left[some], right[some]
            level = self.log[right - left]
            one, two = self.table[level, left], self.table[level, right - (1 << level)]
            top = np.where(impact[two] > impact[one], two, one)
            share = times * impact[top]
            bound, first = int(share.sum()), int(self.doc[left].min())
            if not hopeless(bound, first):
                heappush(heap, (-bound, first, next(turn), int(self.doc[top[share.argmax()]]), lists, times, left, right))

        push(asked, repeats, self.starts[asked], self.starts[asked + 1])
        while heap:
            bound, first, _, at, lists, times, left, right = heappop(heap)
            if hopeless(-bound, first):
                if len(best) == limit and -bound < -best[-1][0]:
                    break
                continue
            opened += 1
            sizes = right - left
            if sizes.sum() <= leaf:
                spots = np.repeat(left - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
                docs, place = np.unique(self.doc[spots], return_inverse=True)
                scores = np.zeros(len(docs), np.int64)
                np.add.at(scores, place, np.repeat(times, sizes) * impact[spots])
                # equal scores in order of documents
                for i in np.argsort(-scores, kind="stable")[:limit].tolist():
                    offer(int(docs[i]), int(scores[i]))
                continue
            spot = np.searchsorted(keys, lists * self.width + at)
            here = (spot < right) & (keys[np.minimum(spot, len(keys) - 1)] == lists * self.width + at)
            offer(at, int((times[here] * impact[spot[here]]).sum()))
            push(lists, times, left, spot)
            push(lists, times, spot + here, right)
        return opened


def _occurrences(batch: pa.RecordBatch, vocabulary: dict[bytes, int]) -> Iterator[tuple[int, list[int]]]:
    """Number of terms of each text, and the ids of those that are asked for."""
    for text in batch.column(batch.num_columns - 1):
        found = terms(text.as_py())
        yield len(found), [i for i in map(vocabulary.get, found) if i is not None]


def _search_block(docs: DataFrame, asked: list[tuple[int, str]], limit: int, shard: int) -> DataFrame:
    """``(q, key, score)``: the best of every task for the items ``(q, text)``, all of ``docs (key, text)``."""
    spark = docs.sparkSession
    wanted = [(q, Counter(terms(text))) for q, text in asked]
    words = sorted({t for _, found in wanted for t in found})
    known = spark.sparkContext.broadcast({t: i for i, t in enumerate(words)})

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of a task: documents with terms (-2), terms (-1), documents holding each asked term."""
        holding, documents, total = np.zeros(len(words), np.int64), 0, 0
        for batch in batches:
            for n, ids in _occurrences(batch, known.value):
                documents += n > 0
                total += n
                holding[list(set(ids))] += 1
        some = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], some])), pa.array(np.concatenate([[documents, total], holding[some]]))],
            names=["id", "n"])

    # one row for each asked term
    sums = {r.id: r.n for r in docs.mapInArrow(statistics, "id bigint, n bigint")
            .groupBy("id").agg(F.sum("n").alias("n")).collect()}
    documents, total = sums.get(-2, 0), sums.get(-1, 0)
    weights = np.array([weight(documents, sums.get(i, 0)) for i in range(len(words))], np.int64)
    place = {t: i for i, t in enumerate(words)}
    plans = spark.sparkContext.broadcast([
        (q, np.array([place[t] for t in found], np.int64), np.array(list(found.values()), np.int64))
        for q, found in wanted if found])
    kind = docs.schema["key"].dataType

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in plans.value]
        names, lengths, found, size, key_type = [], [], [], 0, pa.int64()

        def finish() -> None:
            """One shard: documents in key order, then every item against it."""
            order = pc.sort_indices(pa.array(names, key_type), null_placement="at_end").to_pylist()
            times = np.array([len(found[i]) for i in order], np.int64)
            built = Shard([names[i] for i in order], [lengths[i] for i in order], np.repeat(np.arange(len(order)), times),
                          np.fromiter((t for i in order for t in found[i]), np.int64, times.sum()), weights, documents, total)
            for mine, (_, asked_ids, repeats) in zip(best, plans.value):
                built.search(asked_ids, repeats, mine, limit)

        for batch in batches:
            key_type = batch.schema.field(0).type
            for name, (n, ids) in zip(batch.column(0), _occurrences(batch, known.value)):
                if not ids:
                    continue
                names.append(name.as_py())
                lengths.append(n)
                found.append(np.array(ids, np.int32))
                size += len(ids)
                if size >= shard:
                    finish()
                    names, lengths, found, size = [], [], [], 0
        if names:
            finish()
        rows = [(q, -entry[0], None if entry[1] else entry[2]) for (q, _, _), mine in zip(plans.value, best) for entry in mine]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[2] for r in rows], key_type),
             pa.array([r[1] for r in rows], pa.int64())], names=["q", "key", "score"])

    return docs.mapInArrow(search, f"q bigint, key {kind.simpleString()}, score bigint")


def search(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", limit: int = 10, block_chars: int = BLOCK_CHARS, shard: int = SHARD) -> DataFrame:
    """``(item, rank, key, score)``: for every row of ``items`` the ``limit`` documents with the
    highest score above 0, all if there are fewer; equal scores by ascending key, null last.

    The score sums, over the item's terms with repeats, weight times a saturating share of
    the term's occurrences, in whole numbers.  Items are searched in blocks of about
    ``block_chars`` characters, each against all documents; equal texts are searched once.

    Null and empty texts have no terms: such items get no rows, such documents are never
    found.  Repeated items get equal rows each, repeated documents compete as rows of their
    own.  Texts of any length are read whole; empty tables give no rows; other columns of
    both tables, whatever their names, play no part.
    """
    if item.lower() == key.lower():
        raise ValueError("items and documents need keys of different names")
    asked = cut(items.select(column(item).alias("item"), column(item_text).alias("text"))
                .filter("text IS NOT NULL").withColumn("uid", F.monotonically_increasing_id()))
    texts = cut(asked.select("text").distinct().withColumn("q", F.monotonically_increasing_id()))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = chars // block_chars + 1
    given = docs.select(column(key).alias("key"), column(text).alias("text"))
    found = None
    for block in range(blocks):
        part = [(r.q, r.text) for r in texts.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == block).collect()]
        best = cut(_search_block(given, part, limit, shard))
        found = best if found is None else found.union(best)
    first = Window.partitionBy("q").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= limit)
    return (asked.join(texts, "text").join(best, "q")
            .select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score"))
