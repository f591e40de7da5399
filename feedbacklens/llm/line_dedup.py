"""Line deduplication by levelled sorted runs of line hashes.

``SortedRuns`` counts in how many documents each line stands.  Documents come in
batches: a batch's hashes are counted, merge-anti-joined with the runs written so far,
which leaves out what these already know to be frequent, and written as a run of its own.
A run is a table bucketed and sorted by hash, so that the anti-join does not shuffle it
again.  As soon as a level holds ``FANOUT`` runs they are summed
into one run of the next level, so a hash is rewritten once a level, whatever the number
of batches.

A line is known by 128 bits of hash.  Everything is DataFrame functions.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut, remove, scratch_path, small_side
from .columns import column, others, unused

FANOUT, BATCHES = 4, 4
BLANKS = " \t\n\x0b\f\r"
HASH = ["a", "b"]


def lines_of(text: Column) -> Column:
    """Lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """ASCII white space stripped at both ends, A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def hashes(value: Column) -> list[Column]:
    """128 bits as two longs; the second hash starts from another seed."""
    return [F.xxhash64(value).alias("a"), F.xxhash64(F.lit(1), value).alias("b")]


def line_hashes(docs: DataFrame, text: str = "text", min_chars: int = 1) -> DataFrame:
    """``(a, b)`` once for every document and different key of at least ``min_chars`` characters."""
    keys = F.array_distinct(F.transform(lines_of(column(text)), line_key))
    return (docs.select(F.explode(keys).alias("key")).filter(F.length("key") >= min_chars)
            .select(*hashes(F.col("key"))))


class SortedRuns:
    """How many documents hold a hash, as sorted runs on levels of growing size.

    Hashes that reach ``at_least`` inside one run are frequent whatever comes later, so
    later batches need not count them.
    """

    def __init__(self, spark: SparkSession, at_least: int, fanout: int = FANOUT):
        self.spark, self.at_least, self.fanout = spark, at_least, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> None:
        """Count the hashes ``(a, b)`` of a batch that no run holds as frequent."""
        fresh = batch.groupBy(*HASH).agg(F.count("*").alias("docs"))
        for run in self.runs():
            known = self.spark.table(run).filter(F.col("docs") >= self.at_least)
            fresh = fresh.join(known.select(*HASH).hint("merge"), HASH, "left_anti")
        self._push(0, self._written(fresh))

    def _push(self, level: int, run: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = self._written(self._sums(self.levels[level]))
            self._drop(self.levels[level])
            self.levels[level] = []
            self._push(level + 1, merged)

    def _sums(self, runs: list[str]) -> DataFrame:
        """Sums over runs, read as plain files: one scan of all, partial sums, one shuffle.

        A union of tables that are bucketed alike passes for bucketed in Spark 4.1 where it
        is not, and rows of one hash would stay apart.
        """
        files = self.spark.read.schema("a long, b long, docs long").parquet(*[self.paths[run] for run in runs])
        return files.groupBy(*HASH).agg(F.sum("docs").alias("docs"))

    def _written(self, counts: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = scratch_path(self.spark, "run")
        (counts.write.format("parquet").option("path", self.paths[name])
         .bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name))
        return name

    def _drop(self, runs: list[str]) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE {run}")
            remove(self.spark, self.paths.pop(run))

    def frequent(self) -> DataFrame:
        """``(a, b)`` of all hashes counted at least ``at_least`` times, written; the runs stay."""
        if not self.runs():
            return self.spark.createDataFrame([], "a long, b long")
        return cut(self._sums(self.runs()).filter(F.col("docs") >= self.at_least).select(*HASH))

    def close(self) -> None:
        """Remove all runs."""
        self._drop(self.runs())
        self.levels = []


def drop_lines(docs: DataFrame, frequent: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Replace ``text`` by its lines that are not ``frequent (a, b)`` and add ``n_lines`` and
    ``n_dropped`` (long; replaced if present).

    ``frequent`` is broadcast if it is counted to be small.  Rows that repeat key and text
    get equal results; null and empty texts have one empty line.
    """
    at = unused(docs, "_at")
    row = F.struct(column(key).isNull().alias("none"), F.coalesce(column(key).cast("string"), F.lit("")).alias("key"),
                   *hashes(F.coalesce(column(text), F.lit("")))).alias(at)
    spots = (docs.select(row, F.posexplode(lines_of(column(text))).alias("_place", "_line"))
             .select(at, "_place", *hashes(line_key(F.col("_line")))))
    gone = unused(docs, "_gone")
    dropped = (spots.join(small_side(frequent), HASH, "left_semi")
               .groupBy(at).agg(F.collect_set("_place").alias(gone)))
    lines = unused(docs, "_lines")
    kept = others(docs, text, "n_lines", "n_dropped")
    whole = (docs.withColumn(at, row).join(dropped, at, "left")
             .withColumn(lines, lines_of(column(text))))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    return whole.select(
        *kept,
        F.when(F.col(gone).isNull(), F.coalesce(column(text), F.lit("")))
        .otherwise(F.array_join(F.transform(left, lambda i: F.get(F.col(lines), i)), "\n")).alias(text),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"))


def dedup_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_docs: int = 10,
                min_chars: int = 1, batches: int = BATCHES) -> DataFrame:
    """Remove from every document all lines whose key stands in ``min_docs`` documents or more.

    A key is the line without ASCII white space at its ends, A-Z lower-cased; keys shorter
    than ``min_chars`` characters stay.  ``text`` holds the other lines, and ``n_lines`` and
    ``n_dropped`` count before and after.  Every row is a document of its own, so repeated
    rows count repeatedly; null and empty texts are one empty line and become the empty
    text; texts of any length are read whole; an empty table stays empty; other columns are
    kept.  The result does not depend on ``batches``.
    """
    spark = docs.sparkSession
    runs = SortedRuns(spark, min_docs)
    slot = F.pmod(F.xxhash64(column(text)), F.lit(batches))
    for batch in range(batches):
        runs.add(line_hashes(docs.filter(slot == batch), text, min_chars))
    frequent = runs.frequent()
    runs.close()
    return drop_lines(docs, frequent, key=key, text=text)
