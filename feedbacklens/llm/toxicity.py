"""Toxicity by class-conditional Kneser-Ney models.

For toxic and for ordinary texts, a word's probability follows from the number of
different words it was seen behind (Kneser-Ney's continuation count).  What discounting
takes off goes to the word's first six bytes, from there to its first four, and from
there to counts that both classes share, so that rare expressions borrow from their like.
A toxic text is taken to speak like ordinary ones most of the time: its likelihood is the
mixture of both models.  A text's evidence is the log-likelihood ratio, per word.

Counts are kept for every word and every beginning in tables that grow with the corpus:
a word is its first six bytes and 48 bits of hash, so that words do not share counts.
A word that neither class has counted beyond the discount has no ratio of its own, as what
it would add falls out; it takes that of its beginning, and needs no entry.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut, release
from .columns import column, others
from .labelled import fold, logistic, training_rows
from .word_hash import Words, first_bytes, mix, runs, words

DISCOUNT, TOXIC_SHARE = 2.0, 0.003
#: Entries of a model (12 bytes each) up to which it is sent to every task.
MODEL_ROWS = 4_000_000
#: Words added to a text's length: a single odd word is little evidence in a short text.
EXTRA_WORDS = 5
BINS = 4096
START = np.uint64(7)
#: Bit of a pair's flags by (label, fold).
FLAG = {(0, 0): 1, (0, 2): 2, (1, 0): 4, (1, 2): 8}
#: Ordinary and toxic counts by the flags that they look at: fold 0, fold 2 and both.
COUNTS = {"o0": 1, "o2": 2, "o": 3, "t0": 4, "t2": 8, "t": 12}
#: Classes of the models: of fold 0, of fold 2 and of all that may teach.
MODELS = {"v0": ("o0", "t0"), "v2": ("o2", "t2"), "v": ("o", "t")}
LOW_32 = np.uint64(0xFFFFFFFF)


def names(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """A word in two numbers: its first six bytes above 16 bits of hash, and 32 further bits of hash."""
    key = mix(found.key)
    return first_bytes(found.head, 6) << np.uint64(16) | key >> np.uint64(48), key & LOW_32


def levels(head: np.ndarray, rest: np.ndarray) -> list[np.ndarray]:
    """Keys of words, of their six-byte and of their four-byte beginnings, spread evenly."""
    six = head >> np.uint64(16)
    return [mix(head + mix(rest)), mix(six), mix(six & LOW_32)]


def word_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(head, rest, flags)``: different neighbouring words of labelled texts.

    ``head`` and the upper half of ``rest`` are the word, the lower half of ``rest`` is 32
    bits of hash of the word before it.
    """
    for batch in batches:
        labels, folds = (batch.column(c).to_numpy() for c in ("label", "fold"))
        flags = np.array([FLAG.get((min(max(l, 0), 1), f), 0) for l, f in zip(labels, folds)], np.int64)
        at = 0
        for data, ends in runs(batch.column("text")):
            found = words(data, ends)
            flag = flags[at:at + len(ends)][found.doc]
            at += len(ends)
            if not len(found.key):
                continue
            before = np.concatenate([[START], found.key[:-1]])
            before[np.flatnonzero(np.diff(found.doc, prepend=-1))] = START
            head, rest = names(found)
            rest = rest << np.uint64(32) | mix(before) >> np.uint64(32)
            # flags are four bits: one number holds pair and flags while equal ones are dropped
            pair = mix(head + mix(rest))
            once = np.unique((pair & ~np.uint64(15)) | flag.astype(np.uint64), return_index=True)[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(head[once].view(np.int64)), pa.array(rest[once].view(np.int64)), pa.array(flag[once])],
                names=["head", "rest", "flags"])


def continuation_counts(pairs: DataFrame) -> DataFrame:
    """``(head, rest)`` of every word with the number of different words it was seen behind."""
    once = pairs.groupBy("head", "rest").agg(F.bit_or("flags").alias("flags"))
    return once.groupBy("head", F.expr("shiftrightunsigned(rest, 32)").alias("rest")).agg(
        *[F.count_if(F.col("flags").bitwiseAND(bits) > 0).alias(c) for c, bits in COUNTS.items()])


def _summed(df: DataFrame, key: Column, name: str) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(*[F.sum(c).alias(f"{name}_{c}") for c in COUNTS])


class Scale(NamedTuple):
    """What a model needs beside its entries, at the levels of words, six and four bytes."""

    total: tuple[float, float]  # ordinary and toxic
    left: tuple[tuple[float, float], ...]  # what discounting takes off, by level
    beginnings: int  # different four-byte beginnings

    @property
    def empty(self) -> bool:
        return not all(self.total)

    def unknown(self, level: int) -> float:
        """Factor on the ratio of a beginning at ``level`` for a word that only has that."""
        return float(np.prod([toxic / ordinary for ordinary, toxic in self.left[:level]]))


def evidence_of(ratio):
    return F.log1p(TOXIC_SHARE * (ratio - 1))


def entries(counted: DataFrame) -> tuple[DataFrame, dict[str, Scale]]:
    """``(level, head, rest, v0, v2, v)``: what a word says for toxicity in each model, and the scales.

    A value is null where the model has no ratio of its own for that word or beginning.
    """
    six = cut(_summed(counted, F.expr("shiftrightunsigned(head, 16)"), "six"))
    four = cut(_summed(six.select("six", *[F.col(f"six_{c}").alias(c) for c in COUNTS]),
                       F.col("six").bitwiseAND(0xFFFFFFFF), "four"))
    kept = lambda c: F.greatest(F.col(c) - DISCOUNT, F.lit(0.0))
    sums = [table.agg(F.count("*").alias("n"), *[F.sum(f"{at}{c}").alias(c) for c in COUNTS],
                      *[F.sum(kept(at + c)).alias(f"kept_{c}") for c in COUNTS]).first()
            for table, at in ((counted, ""), (six, "six_"), (four, "four_"))]
    scales = {}
    for name, classes in MODELS.items():
        total = tuple(float(sums[0][c] or 0) for c in classes)
        scales[name] = Scale(total, tuple(tuple(1 - (row[f"kept_{c}"] or 0) / (t or 1.0) for c, t in zip(classes, total))
                                          for row in sums), sums[2]["n"])

    def values(deepest: int) -> list[Column]:
        made = []
        for name, classes in MODELS.items():
            scale = scales[name]
            if scale.empty:
                made.append(F.lit(None).cast("float").alias(name))
                continue
            at = ["", "six_", "four_"]
            shared = [F.col(a + classes[0]) + F.col(a + classes[1]) for a in at[deepest:]]
            shared = [None] * deepest + shared
            below = [(shared[2] + 0.5) / (sum(scale.total) + 0.5 * (scale.beginnings + 1))] * 2
            for level in range(2, deepest - 1, -1):
                if level < 2:
                    borrowed = (shared[level] + 0.5) / (shared[level + 1] + 1)
                    below = [b * borrowed for b in below]
                below = [kept(at[level] + c) / t + left * b
                         for c, t, left, b in zip(classes, scale.total, scale.left[level], below)]
            own = F.greatest(*[F.col(at[deepest] + c) for c in classes]) > DISCOUNT
            made.append(F.when(own, evidence_of(scale.unknown(deepest) * below[1] / below[0]))
                        .cast("float").alias(name))
        return made

    under = six.withColumn("four", F.col("six").bitwiseAND(0xFFFFFFFF)).join(four, "four")
    whole = counted.withColumn("six", F.expr("shiftrightunsigned(head, 16)")).join(under, "six")
    none = F.lit(0).cast("long")
    parts = [whole.select(F.lit(0).alias("level"), "head", "rest", *values(0)),
             under.select(F.lit(1).alias("level"), F.col("six").alias("head"), none.alias("rest"), *values(1)),
             four.select(F.lit(2).alias("level"), F.col("four").alias("head"), none.alias("rest"), *values(2))]
    found = cut(parts[0].unionByName(parts[1]).unionByName(parts[2])
                .filter(F.coalesce(*[F.col(name) for name in MODELS]).isNotNull()))
    release(six, four)
    return found, scales


class Level:
    """Values by evenly spread keys: sorted, and found from the place that a key's leading bits name."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        bits = max(int(len(keys)).bit_length(), 1)
        self.shift = np.uint64(64 - bits)
        self.keys = np.concatenate([keys[order], [np.uint64(2**64 - 1)]])
        self.values = np.concatenate([values[order], [np.nan]]).astype(np.float32)
        self.first = np.searchsorted(self.keys[:-1], np.arange(1 << bits, dtype=np.uint64) << self.shift)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, not a number where there is none."""
        at = self.first[(keys >> self.shift).astype(np.int64)]
        behind = np.flatnonzero(self.keys[at] < keys)
        while len(behind):
            at[behind] += 1
            behind = behind[self.keys[at[behind]] < keys[behind]]
        return np.where(self.keys[at] == keys, self.values[at], np.float32(np.nan))


class Model:
    """A model's entries in memory."""

    def __init__(self, table: pa.Table, name: str, scale: Scale):
        self.scale, self.levels = scale, []
        level, head, rest, value = (table.column(c).to_numpy() for c in ("level", "head", "rest", name))
        head, rest, owns = head.view(np.uint64), rest.view(np.uint64), ~np.isnan(value)
        for n in range(3):
            mine = np.flatnonzero(owns & (level == n))
            key = mix(head[mine] + mix(rest[mine])) if n == 0 else mix(head[mine])
            self.levels.append(Level(key, value[mine]))

    def said(self, found: Words) -> np.ndarray:
        """Evidence of each word: by its deepest entry, or that of unknown words."""
        left = np.arange(len(found.key))
        out = np.full(len(left), np.log1p(TOXIC_SHARE * (self.scale.unknown(3) - 1)))
        for level, keys in zip(self.levels, levels(*names(found))):
            value = level.find(keys[left])
            hit = ~np.isnan(value)
            out[left[hit]] = value[hit]
            left = left[~hit]
        return out

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Log-likelihood ratio per word of each text; 0 for texts without words."""
        scores = []
        for data, ends in runs(texts):
            found = words(data, ends)
            if self.scale.empty or not len(found.key):
                scores.append(np.zeros(len(ends)))
                continue
            n = np.bincount(found.doc, minlength=len(ends))
            each = np.bincount(found.doc, self.said(found), minlength=len(ends))
            scores.append(each / (n + EXTRA_WORDS * (n > 0)).clip(1))
        return np.concatenate(scores) if scores else np.zeros(0)


def text_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(row, head, rest, n)``: the different words of each run of texts with their counts."""
    for batch in batches:
        rows, at = batch.column("row").to_numpy(), 0
        for data, ends in runs(batch.column("text")):
            found = words(data, ends)
            row = rows[at:at + len(ends)][found.doc]
            at += len(ends)
            head, rest = names(found)
            _, once, n = np.unique(mix(head + mix(rest)) ^ mix(row.astype(np.uint64)),
                                   return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[once]), pa.array(head[once].view(np.int64)), pa.array(rest[once].view(np.int64)),
                 pa.array(n)], names=["row", "head", "rest", "n"])


class Scorer:
    """Adds evidence to texts: by a model in memory while its entries are few, else by joins."""

    def __init__(self, table: DataFrame, scales: dict[str, Scale]):
        self.table, self.scales = table, scales
        self.sent = table.toArrow() if table.count() <= MODEL_ROWS else None

    def add(self, df: DataFrame, text: Column, kept: list[Column], name: str, out: str) -> DataFrame:
        """``kept`` columns of ``df`` and ``out``, the evidence of ``text`` in model ``name``."""
        if self.sent is None:
            return self._joined(df, text, kept, name, out)
        model = df.sparkSession.sparkContext.broadcast(Model(self.sent, name, self.scales[name]))

        @F.arrow_udf("double")
        def evidence(texts: pa.Array) -> pa.Array:
            return pa.array(model.value.evidence(texts))

        return df.select(*kept, evidence(text).alias(out))

    def _joined(self, df: DataFrame, text: Column, kept: list[Column], name: str, out: str) -> DataFrame:
        # written once, as row numbers must stay when a task is done again
        rows = cut(df.select(F.struct(*kept).alias("kept"), text.alias("text"),
                             F.monotonically_increasing_id().alias("row")))
        scale = self.scales[name]
        said = rows.select("row", "text").mapInArrow(text_words, "row long, head long, rest long, n long")
        said = said.withColumn("six", F.expr("shiftrightunsigned(head, 16)")).withColumn(
            "four", F.col("six").bitwiseAND(0xFFFFFFFF))
        own = self.table.filter(F.col(name).isNotNull())
        for level, keys in ((0, ["head", "rest"]), (1, ["six"]), (2, ["four"])):
            part = own.filter(F.col("level") == level).select(
                *[F.col(c).alias(k) for c, k in zip(("head", "rest"), keys)], F.col(name).alias(f"at_{level}"))
            said = said.join(part, keys, "left")
        unknown = 0.0 if scale.empty else float(np.log1p(TOXIC_SHARE * (scale.unknown(3) - 1)))
        value = F.coalesce("at_0", "at_1", "at_2", F.lit(unknown)).cast("double")
        sums = said.groupBy("row").agg((F.sum(value * F.col("n")) / (F.sum("n") + EXTRA_WORDS)).alias("sum"))
        return rows.select("row", "kept").join(sums, "row", "left").select(
            "kept.*", F.coalesce("sum", F.lit(0.0)).alias(out))


def stretched(evidence: Column) -> Column:
    """Evidence on a scale where texts with few and with many toxic words lie near."""
    return F.log(F.greatest(evidence, F.lit(0.0)) + 1e-3)


LOW, HIGH = float(np.log(1e-3)), 3.0


def score_texts(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text",
                label: str = "toxic", threshold: float = 0.7) -> DataFrame:
    """Add ``held_out, score, predicted`` to every row (same-named columns are replaced).

    Only labelled rows outside fold 1 teach the model.  The scale of the score is fitted on
    rows that the counts behind it have not seen: each of the two training folds is scored
    with the other's counts.  Null and empty texts get the score of no evidence; texts of any
    length are read whole.  Rows without a label, repeated rows and null keys are scored like
    any other; a row with a null key is in the fold of the empty text.  Without labels of both
    classes every score is 0.5 at most; an empty table stays empty.
    """
    train = training_rows(docs, labels, label, key, text).select("fold", "label", "text")
    counted = cut(continuation_counts(train.mapInArrow(word_pairs, "head long, rest long, flags long")))
    table, scales = entries(counted)
    release(counted)
    scorer = Scorer(table, scales)
    # fold 0 is judged by the counts of fold 2 and the other way round
    parts = [scorer.add(train.filter(F.col("fold") == own), F.col("text"), [F.col("label")], other, "z")
             for own, other in ((0, "v2"), (2, "v0"))]
    place = F.floor((stretched(F.col("z")) - LOW) / (HIGH - LOW) * BINS)
    cells = (parts[0].unionByName(parts[1])
             .groupBy(F.least(F.greatest(place, F.lit(0)), F.lit(BINS - 1)).cast("int").alias("bin"),
                      (F.col("label") > 0).cast("int").alias("label"))
             .agg(F.count("*").alias("n")).toArrow())  # at most 2 x BINS rows
    middle = LOW + (cells.column("bin").to_numpy() + 0.5) / BINS * (HIGH - LOW)
    slope, intercept = logistic(middle, cells.column("label").to_numpy().astype(float),
                                cells.column("n").to_numpy().astype(float))

    added = ["held_out", "score", "predicted"]
    scored = scorer.add(docs, column(text), [*others(docs, *added), (fold(column(key)) == 1).alias("held_out")], "v", "score")
    z = slope * stretched(F.col("score")) + intercept
    scored = scored.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(700.0)), F.lit(-700.0)))))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
