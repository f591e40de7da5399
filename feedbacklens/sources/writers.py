"""Writers.  Every output is a folder of files written in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from ..functions import text as T
from ..operators.hypotheses import output_files


def tsv(df: DataFrame, path: str, header: bool = False) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", header).csv(path)


def stories(df: DataFrame, path: str) -> None:
    """Story documents as ``(story_id, story)`` Parquet, by split when there is one."""
    writer = df.write.mode("overwrite")
    if "split" in df.columns:
        writer = writer.partitionBy("split")
    writer.parquet(path)


def records(df: DataFrame, path: str, rows_per_file: int = 1_000) -> None:
    """Model records in files of at most ``rows_per_file`` rows."""
    df.select("article", "abstract").write.mode("overwrite").option(
        "maxRecordsPerFile", rows_per_file).parquet(path)


def vocabulary(vocab: DataFrame, path: str) -> None:
    """``word count`` lines, most frequent first; the reserved ids are not written."""
    lines = vocab.filter(F.col("id") >= 4).orderBy("id").select(
        F.concat_ws(" ", "word", F.col("cnt").cast("string")).alias("value"))
    lines.write.mode("overwrite").text(path)


def vocabulary_metadata(vocab: DataFrame, path: str) -> None:
    """One word per line in id order."""
    vocab.orderBy("id").select(F.col("word").alias("value")).write.mode("overwrite").text(path)


def id_lists(lists: DataFrame, path: str) -> None:
    lists.select("split", F.col("story_id").alias("value")).write.mode("overwrite").partitionBy(
        "split").text(path)


def ranked_concepts(df: DataFrame, path: str) -> None:
    df.orderBy(F.desc("label"), F.desc("score")).write.mode("overwrite").parquet(path)


def binary_coded(df: DataFrame, folder: str) -> str:
    """Wide table with a header under a date-stamped name; returns the path."""
    stamp = df.sparkSession.sql("SELECT date_format(current_date(), 'yyyyMMdd')").first()[0]
    path = f"{folder}/Binary_Coded_{stamp}.tsv"
    tsv(df, path, header=True)
    return path


def generated(df: DataFrame, index: str, path: str) -> None:
    """Reference and generated text per example, keyed by six-digit file names."""
    output_files(df, index).write.mode("overwrite").parquet(path)


def lines(df: DataFrame, path: str) -> None:
    """A one-column text report."""
    df.write.mode("overwrite").text(path)


def attention(df: DataFrame, path: str) -> None:
    """JSON documents of column ``json``, one per line."""
    df.select(F.col("json").alias("value")).write.mode("overwrite").text(path)


def safe_text(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, T.html_safe(F.col(column)))


class CountsDiffer(ValueError):
    """A written table does not have the rows that were promised."""


def reconciled(df: DataFrame, path: str, expected: int, name: str = "rows", **options: str) -> int:
    """Write ``df`` as Parquet while counting its rows, and fail unless they are ``expected``.

    The count is a metric on the plan that writes, so no table is read a second time.  Rows are
    written beside ``path`` first and take its place only when the count is right: a table with
    lost or doubled rows is never seen there, and what was there before stays.  Returns the
    count; an empty table counts zero.
    """
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    beside = hadoop.Path(f"{path.rstrip('/')}._unchecked")
    place = beside.getFileSystem(spark._jsc.hadoopConfiguration())
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").options(**options).parquet(beside.toString())
    rows = seen.get["rows"]
    if rows != expected:
        place.delete(beside, True)
        raise CountsDiffer(f"{name}: {rows} rows written, {expected} expected")
    target = hadoop.Path(path)
    if place.exists(target):
        place.delete(target, True)
    if not place.rename(beside, target):
        raise OSError(f"{name}: {beside} could not be put in place")
    return rows
