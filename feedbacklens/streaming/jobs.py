"""Incremental forms of scoring, metric tracking and resource refresh."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import prepare
from ..operators.metrics import CLIP, DECAY, best_so_far, running_loss
from ..operators.moves import HUB_ROWS, meet
from ..session import cut, release, remove, scratch_path


def file_stream(spark: SparkSession, path: str, schema, pattern: str = "*.parquet",
                files_per_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def table_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """A Parquet table, one file or a folder of files, as a stream of the files it has.

    Its last letter is written as a pattern: a stream takes a plain path for a folder, while
    a pattern may name a file too.  The files of a folder are those a batch reader takes.
    """
    schema = spark.read.parquet(path).schema
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{path[:-1]}[{path[-1]}]")
    )


def score_stream(feedback: DataFrame, concepts: DataFrame) -> DataFrame:
    """Cleaned, still uncoded feedback of a stream, against coded concepts."""
    return prepare.uncoded(prepare.clean_feedback(feedback), concepts)


def append_files(stream: DataFrame, out: str) -> StreamingQuery:
    """Process everything available now and append it to Parquet files, exactly once."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", out + "-progress").option("path", out)
        .trigger(availableNow=True).start()
    )


LOSSES = "series long, step long, loss double"
COUNTED = LOSSES + ", running_avg double, is_best boolean, late boolean"
SERIES = "series long, running_avg double, best double, last long, newest long"


def _state(spark: SparkSession, out: str, number: int) -> tuple[DataFrame, DataFrame]:
    """Waiting rows and series as micro-batch ``number`` left them; nothing before the first."""
    if number < 0:
        return spark.createDataFrame([], LOSSES), spark.createDataFrame([], SERIES)
    path = f"{out}-state/batch={number}"
    return spark.read.schema(LOSSES).parquet(f"{path}/open"), spark.read.schema(SERIES).parquet(f"{path}/series")


def _advance(batch: DataFrame, number: int, out: str, wait: int, decay: float, clip: float) -> None:
    """One micro-batch of ``running_loss_job``; done again, it replaces what it wrote."""
    spark = batch.sparkSession
    waiting, series = _state(spark, out, number - 1)
    rows = cut(batch.select("series", "step", "loss").unionByName(waiting))
    many = rows.count() > HUB_ROWS
    newest = (rows.groupBy("series").agg(F.max("step").alias("newest"))
              .unionByName(series.select("series", "newest")).groupBy("series").agg(F.max("newest").alias("newest")))
    known = cut(newest.join(series.drop("newest"), "series", "left"))
    late, ready = F.col("last").isNotNull() & (F.col("step") <= F.col("last")), F.col("step") <= F.col("newest") - wait
    judged = cut(meet(rows, known, ["series"], many).select(
        "series", "step", "loss", late.alias("late"), (~late & ready).alias("ready")))
    counted = running_loss(judged.filter("ready").select("series", "step", "loss"), "series", "step", "loss",
                           decay, clip, known.filter("running_avg IS NOT NULL"))
    counted = counted.withColumn("_seen", F.round("running_avg", 9))  # averages that differ by rounding are one value
    counted = cut(best_so_far(counted, "series", "step", "_seen", known))
    missed = judged.filter("late").select("series", "step", "loss", F.lit(None).cast("double").alias("running_avg"),
                                          F.lit(None).cast("boolean").alias("is_best"), F.lit(True).alias("late"))
    (counted.select("series", "step", "loss", "running_avg", "is_best", F.lit(False).alias("late")).unionByName(missed)
     .write.mode("overwrite").parquet(f"{out}/batch={number}"))
    path = f"{out}-state/batch={number}"
    judged.filter("not late and not ready").select("series", "step", "loss").write.mode("overwrite").parquet(f"{path}/open")
    ends = counted.groupBy("series").agg(F.max_by("running_avg", "step").alias("_avg"), F.min("_seen").alias("_best"),
                                         F.max("step").alias("_last"))
    known.join(ends, "series", "left").select(
        "series", F.coalesce("_avg", "running_avg").alias("running_avg"), F.least("_best", "best").alias("best"),
        F.coalesce("_last", "last").alias("last"), "newest").write.mode("overwrite").parquet(f"{path}/series")
    release(rows, known, judged, counted)
    if number > 1:  # the last two states are enough to do a batch again
        remove(spark, f"{out}-state/batch={number - 2}")


def running_loss_job(metrics: DataFrame, out: str, wait: int = 0, decay: float = DECAY, clip: float = CLIP) -> StreamingQuery:
    """Running average and best-so-far of a ``(series, step, loss)`` stream, in order of steps.

    A step waits until its series has got ``wait`` steps further, whatever files they come
    in; then it counts, in its place.  A step at or before the last one counted comes too
    late: it is returned with ``late`` set and without values.  Every micro-batch runs the
    batch operator on what became ready, starting from the averages kept of each series, so
    that a series of any share of the rows is spread over tasks.  Averages, bests and
    waiting steps are tables beside ``out``, one state a micro-batch, and a micro-batch
    that is done again replaces its output and its state.  ``finish`` counts what waits.
    """
    def handle(batch: DataFrame, number: int) -> None:
        _advance(batch, number, out, wait, decay, clip)

    return (
        metrics.writeStream.foreachBatch(handle)
        .option("checkpointLocation", out + "-progress").trigger(availableNow=True).start()
    )


def finish(spark: SparkSession, out: str, decay: float = DECAY, clip: float = CLIP) -> None:
    """Count the steps that still wait, the stream of ``running_loss_job`` having ended."""
    place = spark._jvm.org.apache.hadoop.fs.Path(out + "-state")
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    states = [f.getPath().getName() for f in system.listStatus(place)] if system.exists(place) else []
    last = max((int(name.partition("=")[2]) for name in states), default=-1)
    _advance(spark.createDataFrame([], LOSSES), last + 1, out, 0, decay, clip)


def losses(spark: SparkSession, metrics: DataFrame, name: str, wait: int = 0) -> DataFrame:
    """Run a loss stream over all available files and return every step, none of them waiting."""
    out = scratch_path(spark, name)
    running_loss_job(metrics, out, wait).awaitTermination()
    finish(spark, out)
    return spark.read.schema(COUNTED).parquet(out).select("series", "step", "loss", "running_avg", "is_best", "late")


def refreshed_stream(stream: DataFrame, side_path: str,
                     use: Callable[[DataFrame, DataFrame], DataFrame], out: str) -> StreamingQuery:
    """Apply ``use(batch, side)`` with the side table as it is at each micro-batch.

    A batch is written under its own number, so a repeated batch replaces itself.
    """

    def handle(batch: DataFrame, number: int) -> None:
        side = batch.sparkSession.read.parquet(side_path)
        use(batch, side).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", out + "-progress").trigger(availableNow=True).start()
    )


def run_to_table(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over all available files and return what it wrote."""
    out = scratch_path(spark, name)
    append_files(stream, out).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
