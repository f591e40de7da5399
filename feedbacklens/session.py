"""Session helpers: a local session for tests, and reliable lineage cuts."""

from __future__ import annotations

import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


def local_session(cores: str = "8", shuffle_partitions: int | None = None) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("feedbacklens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once per application.

    Functions that run in Python on executors are imported there by name; a package that
    is installed or on the workers' path does not need this.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="feedbacklens-"), "feedbacklens"), "zip",
        os.path.dirname(package), os.path.basename(package))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local master may
    fall back to a temporary folder, because there every task sees it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="feedbacklens-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for one job's own files."""
    return os.path.join(_own_dir(spark), f"{name}-{uuid.uuid4().hex}")


def _own_dir(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark), f"feedbacklens-{spark.sparkContext.applicationId}")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This ends the lineage, survives lost executors, and gives later plans the
    true size: a checkpointed plan would keep its estimate, which multiplies
    with every join of an iteration.  Its shuffle files go as soon as it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    for paths in _made()[-1:]:
        paths.append(path)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    read = spark.read.schema(df.schema).parquet(path)
    read.cut_path = path
    return read


#: Removes the shuffle files of a query that has ended; otherwise they stay until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CUTS = threading.local()


def _made() -> list[list[str]]:
    """The paths that were cut inside each ``settled`` that is going on in this thread."""
    if not hasattr(_CUTS, "made"):
        _CUTS.made = []
    return _CUTS.made


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """``cut(make())``, after which the tables that were cut on the way are removed.

    What ``make`` reads has to be made before.
    """
    _made().append([])
    try:
        df = make()
    except BaseException:
        _made().pop()
        raise
    paths = _made().pop()
    result = cut(df)
    for path in paths:
        remove(df.sparkSession, path)
    return result


#: Rows of a table of words up to which it is sent to every task (tens of megabytes).
SMALL_ROWS = 1_000_000


def small_side(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is counted to be small; else both sides are shuffled."""
    return F.broadcast(df) if df.count() <= rows else df


def release(*tables: DataFrame) -> None:
    """Remove ``cut`` tables that nothing reads any more, as a loop's earlier states."""
    for table in tables:
        remove(table.sparkSession, table.cut_path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all files this application left in the shared folder, after its last action."""
    remove(spark, _own_dir(spark))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path that ``scratch_path`` gave, wherever the shared folder is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
