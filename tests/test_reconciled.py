"""Rows are counted by the job that writes them."""

import os

import pytest
from pyspark.sql import functions as F

from feedbacklens.sources import writers


def test_rows_are_counted_while_written(spark, tmp_path):
    path = str(tmp_path / "out")
    visits = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            visits.add(batch.num_rows)
            yield batch

    rows = spark.range(1000, numPartitions=7).mapInArrow(count, "id long")
    assert writers.reconciled(rows, path, 1000, "comments") == 1000
    assert visits.value == 1000  # one pass
    assert spark.read.parquet(path).agg(F.sum("id")).first()[0] == 499_500


def test_a_lost_row_fails_and_keeps_the_former_table(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.reconciled(spark.range(5), path, 5)
    with pytest.raises(writers.CountsDiffer, match="comments: 9 rows written, 10 expected"):
        writers.reconciled(spark.range(9), path, 10, "comments")
    assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_path) == ["out"]
    assert writers.reconciled(spark.range(12).repartition(3), path, 12) == 12
    assert spark.read.parquet(path).count() == 12


def test_an_empty_table_counts_zero(spark, tmp_path):
    assert writers.reconciled(spark.range(0), str(tmp_path / "none"), 0) == 0
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
