"""Alignment of two tokenizers over a corpus: which tokens overlap, and how often.

Documents are encoded in blocks of bounded size.  A block's pair-document records stay at
home, written once; what travels are its pairs with their counts, radix-partitioned by the
B token into runs that are sorted by B token and then A token (side-major) and compressed
with zstd.  A tree of k-way heap merges, ``FANIN`` runs at a time, counts every pair of the
corpus; side-major order gives each B token's highest count as soon as its last A token
has passed.  The counts stream back down the same tree, each block gets those of its own
pairs, and only then are they summed over its documents.

So a pair that holds a third of all links is one entry of a run, like any other, and no
task holds more than ``FANIN`` runs of one radix.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ..session import cut
from .byte_bpe import PUBLIC_PATTERN, broadcast_file, read_ranks
from .columns import column

BLOCK_BYTES, RADIXES, FANIN = 1_000_000, 64, 256
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
#: characters beyond those whose classes every Unicode version agrees on
BEYOND = re.compile("[^\x00-ɏ]")
SIDE = 32  # bits of the A id in a pair


def byte_of_letter() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def piece_bytes(piece: str) -> bytes:
    """Bytes of one B piece."""
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Encoders:
    """Both tokenizers and the bytes of their tokens.

    With ``ranks``, the same vocabulary as a rank file, texts of Latin characters are
    encoded from it, which gives equal ids in a quarter of the time.
    """

    def __init__(self, a_file: bytes, b_file: bytes, ranks: bytes | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_file)
        self.ranked = None
        if ranks:
            import tiktoken

            self.ranked = tiktoken.Encoding("ranks", pat_str=PUBLIC_PATTERN, mergeable_ranks=read_ranks(ranks),
                                            special_tokens={})
        letters = byte_of_letter()
        words = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(words.values()) + 1)
        for word, at in words.items():
            self.a_bytes[at] = bytes(letters[c] for c in word) if all(c in letters for c in word) else word.encode()
        self.b_bytes = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = (np.array([len(t) for t in table]) for table in (self.a_bytes, self.b_bytes))
        self.most = max(len(self.a_bytes), len(self.b_bytes))
        #: what ``described`` writes for each id and separator
        self.shown = [f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(self.most)]

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides for each text; none where the bytes do not come out as space and text."""
        slow = [i for i, t in enumerate(texts) if t and (self.ranked is None or BEYOND.search(t))]
        coded = dict(zip(slow, self.a.encode_batch_fast([f" {texts[i]}" for i in slow], add_special_tokens=False)))
        pieces = self.b.encode(texts, num_threads=1)
        found = []
        for i, (text, b) in enumerate(zip(texts, pieces)):
            if not text:
                found.append(([], []))
                continue
            a = coded[i].ids if i in coded else self.ranked.encode_ordinary(f" {text}")
            whole = b" " + text.encode()
            same = (b"".join(map(self.a_bytes.__getitem__, a)) == whole
                    and b"".join(map(self.b_bytes.__getitem__, b)) == whole)
            found.append((a, b) if same else ([], []))
        return found


@lru_cache(maxsize=2)
def encoders_for(a_file: bytes, b_file: bytes, ranks: bytes | None) -> Encoders:
    """One per worker process."""
    return Encoders(a_file, b_file, ranks)


# -- packed numbers ---------------------------------------------------------------------


def pack(*columns: np.ndarray) -> bytes:
    """Arrays of whole numbers of one length or more, their bytes sorted by weight, in zstd."""
    from zstandard import ZstdCompressor

    sizes = np.array([len(columns), *map(len, columns)], "<i8").tobytes()
    parts = [np.ascontiguousarray(c, "<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns]
    return ZstdCompressor(level=1).compress(b"".join([sizes, *parts]))


def unpack(data: bytes) -> list[np.ndarray]:
    from zstandard import ZstdDecompressor

    raw = ZstdDecompressor().decompress(data)
    many = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes, at, found = np.frombuffer(raw, "<i8", many, 8), 8 * (many + 1), []
    for size in sizes.tolist():
        part = np.frombuffer(raw, np.uint8, 8 * size, at).reshape(8, size)
        found.append(np.ascontiguousarray(part.T).view("<i8").reshape(-1))
        at += 8 * size
    return found


def pack_run(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted run of pairs ``b << SIDE | a`` with their counts."""
    return pack(np.diff(pairs, prepend=0), counts)


def unpack_run(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = unpack(data)
    return np.cumsum(steps), counts


# -- a block of documents -----------------------------------------------------------------


class Block:
    """What a block's documents say, all at once: token ends on one line of bytes."""

    def __init__(self, encoders: Encoders, texts: list[str]):
        ids = encoders.encode(texts)
        self.n_a, self.n_b = (np.array([len(row[side]) for row in ids], np.int64) for side in (0, 1))
        a, b = (np.array(list(chain.from_iterable(row[side] for row in ids)), np.int64) for side in (0, 1))
        end_a, end_b = np.cumsum(encoders.a_size[a]), np.cumsum(encoders.b_size[b])
        # where each document ends on that line; a document without tokens has no length
        self.ends = np.concatenate([[0], end_a])[np.cumsum(self.n_a)]
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")  # two sorted runs
        twice = ends[1:] == ends[:-1]
        links, groups = ends[np.append(~twice, True)[:len(ends)]], ends[:-1][twice]
        of_a, of_b = np.searchsorted(end_a, links), np.searchsorted(end_b, links)
        self.pairs = (b[of_b] << SIDE) | a[of_a]
        self.doc = np.searchsorted(self.ends, links)
        self.n_links = np.bincount(self.doc, minlength=len(texts))
        self.n_groups = np.bincount(np.searchsorted(self.ends, groups), minlength=len(texts))
        self.digests = self._digests(encoders, a, b, np.searchsorted(groups, end_a), np.searchsorted(groups, end_b))

    def _digests(self, encoders: Encoders, a, b, group_a, group_b) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2``: groups in order, A ids before B ids."""
        place = np.concatenate([2 * group_a, 2 * group_b + 1])
        order = np.argsort(place, kind="stable")
        place, ids = place[order], np.concatenate([a, b])[order]
        mark = np.full(len(ids), 2)
        mark[:-1][place[1:] == place[:-1]] = 0
        mark[:-1][(place[1:] != place[:-1]) & (place[:-1] % 2 == 0)] = 1
        stops = np.cumsum(self.n_a + self.n_b)
        mark[stops[self.n_a > 0] - 1] = 3
        shown = list(map(encoders.shown.__getitem__, (mark * encoders.most + ids).tolist()))
        return [hashlib.sha256("".join(shown[start:stop]).encode()).hexdigest() if stop > start else ""
                for start, stop in zip([0, *stops.tolist()], stops.tolist())]

    def runs(self) -> tuple[bytes, list[tuple[int, bytes]]]:
        """The records, document by document, and a run of pairs for each radix."""
        pairs, at = np.unique(self.pairs, return_inverse=True)
        radix = (pairs >> SIDE) % RADIXES
        order = np.argsort(radix, kind="stable")
        place = np.empty(len(pairs), np.int64)
        place[order] = np.arange(len(pairs))
        pairs, at = pairs[order], place[at]
        counts = np.bincount(at, minlength=len(pairs))
        records, times = np.unique(self.doc * max(len(pairs), 1) + at, return_counts=True)
        doc, at = np.divmod(records, max(len(pairs), 1))
        sizes = np.bincount(doc, minlength=len(self.n_a))
        cuts = np.searchsorted(radix[order], np.arange(RADIXES + 1)).tolist()
        return pack(sizes, at, times), [(r, pack_run(pairs[s:e], counts[s:e]))
                                        for r, (s, e) in enumerate(zip(cuts, cuts[1:])) if e > s]


def blocks_of(batch: pa.RecordBatch, texts: pa.Array, limit: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """A batch in slices of about ``limit`` characters; a longer text is a slice of its own."""
    rows, size, start = [], 0, 0
    for at, text in enumerate(texts):
        rows.append(text.as_py() or "")
        size += len(rows[-1])
        if size >= limit or at + 1 == batch.num_rows:
            yield batch.slice(start, at + 1 - start), rows
            rows, size, start = [], 0, at + 1


# -- counting over the corpus ---------------------------------------------------------------


def merged(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """K-way heap merge of sorted runs, one B token after another; equal pairs are summed."""
    def groups(data: bytes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        pairs, counts = unpack_run(data)
        side, starts = np.unique(pairs >> SIDE, return_index=True)
        stops = np.append(starts[1:], len(pairs))
        for b, start, stop in zip(side.tolist(), starts.tolist(), stops.tolist()):
            yield b, id(data), pairs[start:stop], counts[start:stop]

    found = []
    for _, same in groupby(heapq.merge(*map(groups, runs), key=lambda g: g[:2]), key=lambda g: g[0]):
        same = list(same)
        if len(same) == 1:
            found.append(same[0][2:])
            continue
        pairs, at = np.unique(np.concatenate([g[2] for g in same]), return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, at, np.concatenate([g[3] for g in same]))
        found.append((pairs, counts))
    return tuple(np.concatenate(x) if found else np.empty(0, np.int64) for x in (zip(*found) if found else ((), ())))


def marked(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Twice each count, plus one where it is its B token's highest."""
    side, starts = np.unique(pairs >> SIDE, return_index=True)
    highest = np.maximum.reduceat(counts, starts) if len(pairs) else counts
    return 2 * counts + (counts == np.repeat(highest, np.diff(np.append(starts, len(pairs)))))


RUN = "radix int, node bigint, run binary"
ANSWER = "radix int, node bigint, answer binary"


def _merge(key, table):
    run = pack_run(*merged(table["run"].to_pylist()))
    return pa.table({"radix": pa.array([key[0].as_py()], pa.int32()), "node": pa.array([key[1].as_py()], pa.int64()),
                     "run": pa.array([run], pa.binary())})


def _top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):  # one run holds a radix's pairs: one at a time
            row = batch.slice(i, 1)
            answer = pack(marked(*unpack_run(row["run"][0].as_py())))
            yield pa.RecordBatch.from_arrays([row["radix"], row["node"], pa.array([answer], pa.binary())],
                                             names=["radix", "node", "answer"])


def _back(key, table):
    """Counts of a parent's pairs, looked up for each of its children."""
    parent = table.filter(pa.compute.is_valid(table["answer"]))
    pairs, _ = unpack_run(parent["run"][0].as_py())
    answer, = unpack(parent["answer"][0].as_py())
    children = table.filter(pa.compute.is_null(table["answer"]))
    found = [pack(answer[np.searchsorted(pairs, unpack_run(run)[0])]) for run in children["run"].to_pylist()]
    return pa.table({"radix": pa.array([key[0].as_py()] * len(found), pa.int32()),
                     "node": pa.array(children["node"].to_pylist(), pa.int64()), "answer": pa.array(found, pa.binary())})


def corpus_counts(runs: DataFrame, blocks: int, fanin: int = FANIN) -> DataFrame:
    """``(radix, node, answer)`` for every run ``(radix, node, run)`` of ``blocks`` nodes.

    Up the tree pairs are summed, at the top each radix is one run, and down the tree every
    node gets its pairs' counts from its parent.
    """
    if fanin < 4:
        raise ValueError("a node must take in four runs or more for the tree to end")
    levels, width = [runs], blocks
    while width > 1 or len(levels) == 1:
        width = 1 if width <= fanin else -(-2 * width // fanin)
        below = levels[-1].withColumn("parent", F.pmod(F.xxhash64("node"), F.lit(width)).cast("bigint"))
        levels[-1] = below
        levels.append(cut(below.groupBy("radix", "parent").applyInArrow(_merge, RUN)))
    answers = cut(levels[-1].mapInArrow(_top, ANSWER))
    for parents, below in zip(reversed(levels[1:]), reversed(levels[:-1])):
        known = (parents.join(answers, ["radix", "node"]).select(
            "radix", F.col("node").alias("parent"), F.lit(None).cast("bigint").alias("node"), "run", "answer"))
        both = known.unionByName(below.select("radix", "parent", "node", "run", F.lit(None).cast("binary").alias("answer")))
        answers = cut(both.groupBy("radix", "parent").applyInArrow(_back, ANSWER))
    return answers


def _sums(key, table):
    """One block: its records meet the counts of its pairs, radix by radix."""
    records = table.filter(pa.compute.is_null(table["radix"]))["data"][0].as_py()
    answers = table.filter(pa.compute.is_valid(table["radix"])).sort_by("radix")
    counts = np.concatenate([np.empty(0, np.int64), *(unpack(a)[0] for a in answers["data"].to_pylist())])
    sizes, at, times = unpack(records)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    total = lambda values: np.diff(np.concatenate([[0], np.cumsum(values)])[ends])
    return pa.table({
        "_block": pa.array([key[0].as_py()] * len(sizes), pa.int64()), "_at": pa.array(np.arange(len(sizes)), pa.int32()),
        "n_best": pa.array(total(times * (counts[at] & 1)), pa.int64()),
        "count_sum": pa.array(total(times * (counts[at] >> 1)), pa.int64())})


def align(docs: DataFrame, a_path: str, b_path: str, *, ranks: str | None = None, text: str = "text",
          carry: Sequence[str] | None = None, block_bytes: int = BLOCK_BYTES, fanin: int = FANIN) -> DataFrame:
    """``carry`` (default: all columns but ``text`` and those named like a result) and, per
    row, ``n_a, n_b, n_groups, n_links, n_best, count_sum`` (long) and ``groups_sha256``.

    A is a byte-level vocabulary in JSON, B a piece model that adds a space in front; both
    encode space + text, special strings being plain text.  Groups end where tokens of both
    sides end.  A link is a pair of tokens whose byte ranges overlap; its count is the
    number of links in the corpus between the same ids; ``n_best`` counts links whose count
    is the highest of their B id, ties included.

    Null and empty texts, and texts whose tokens do not give their bytes again, have zeros
    and an empty digest and add nothing to the counts.  Repeated rows count repeatedly; a
    text of any length is encoded whole; an empty table gives none.
    """
    spark = docs.sparkSession
    results = [*COUNTS, "n_best", "count_sum", "groups_sha256"]
    names = list(carry) if carry is not None else [
        c for c in docs.columns if c.lower() not in {text.lower(), *results}]
    given = docs.select(*[column(c).alias(f"c{i}") for i, c in enumerate(names)], column(text).alias("text"))
    kept = StructType(given.schema.fields[:-1])
    files = [broadcast_file(spark, path) if path else None for path in (a_path, b_path, ranks)]
    made = "_block bigint, _at int, radix int, data binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
    schema = StructType([*kept.fields, *StructType.fromDDL(made).fields])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = encoders_for(*[f and f.value for f in files])
        number = TaskContext.get().partitionId() << 32
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), *[pa.int64()] * 4, pa.string()]
        for batch in batches:
            for part, texts in blocks_of(batch, batch.column(batch.num_columns - 1), block_bytes):
                block, n = Block(encoders, texts), part.num_rows
                own = [part.column(i) for i in range(part.num_columns - 1)]
                new = [[number] * n, range(n), None, None, block.n_a, block.n_b, block.n_groups, block.n_links, block.digests]
                arrays = own + [pa.nulls(n, k) if x is None else pa.array(x, k) for x, k in zip(new, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
                records, runs = block.runs()
                m = len(runs) + 1
                new = [[number] * m, None, [None, *(r for r, _ in runs)], [records, *(run for _, run in runs)], *[None] * 5]
                arrays = [pa.nulls(m, c.type) for c in own] + [
                    pa.nulls(m, k) if x is None else pa.array(x, k) for x, k in zip(new, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
                number += 1

    stage = cut(given.mapInArrow(encode, schema))
    records = stage.filter("_at IS NULL AND radix IS NULL").select("_block", "radix", "data")
    runs = stage.filter("radix IS NOT NULL").select("radix", F.col("_block").alias("node"), F.col("data").alias("run"))
    answers = corpus_counts(runs, records.count(), fanin).select(
        F.col("node").alias("_block"), "radix", F.col("answer").alias("data"))
    sums = records.unionByName(answers).groupBy("_block").applyInArrow(
        _sums, "_block bigint, _at int, n_best bigint, count_sum bigint")
    return (stage.filter("_at IS NOT NULL").drop("radix", "data").join(sums, ["_block", "_at"])
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], *COUNTS, "n_best", "count_sum", "groups_sha256"))
