"""Wide coding with discovered columns."""

import pytest
from pyspark.sql import functions as F

from feedbacklens.operators import coding
from feedbacklens.session import scratch_path

RANKED = "sno long, label string, concept string, score double"


def lexicon(spark):
    return spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "word string, valence double")


def test_read_back_of_discovered_columns(spark):
    rows = [(1, "a", " good food ", 0.5), (2, "a", "bad service", 0.1), (3, "b", "good food", 0.9), (None, "b", "plain", 0.2),
            (3, "b", "good food", 0.9)]
    ranked = spark.createDataFrame(rows, RANKED)
    dictionary = coding.discover(ranked)
    assert [r.concept for r in dictionary.orderBy("column").collect()] == ["bad service", "good food", "plain"]
    folder = scratch_path(spark, "wide")
    coding.write_wide(coding.sparse_code(ranked, lexicon(spark), dictionary), dictionary, folder, width=2)
    wide = coding.read_wide(spark, folder)
    assert wide.columns == [*coding.FIXED, "bad service", "good food", "plain"]
    got = sorted((str(r.sno), r["bad service"], r["good food"], r["plain"], r.sentiment_compound > 0) for r in wide.collect())
    assert got == [("1", 0, 1, 0, True), ("2", 1, 0, 0, False), ("3", 0, 1, 0, True), ("3", 0, 1, 0, True), ("None", 0, 0, 1, False)]
    some = coding.read_wide(spark, folder, ["plain", "never seen"])
    assert some.agg(F.sum("plain"), F.sum("never seen")).first()[:] == (1, 0)


def test_ten_thousand_concepts(spark):
    """Groups of bounded width, no projection with a term per concept."""
    ranked = spark.range(20_000).select(
        "id", F.lit("a").alias("label"), F.format_string("concept %05d", F.col("id") % 10_000).alias("concept"),
        F.lit(0.5).alias("score")).withColumnRenamed("id", "sno")
    dictionary = coding.discover(ranked)
    sparse = coding.sparse_code(ranked, lexicon(spark), dictionary)
    assert len(sparse._jdf.queryExecution().optimizedPlan().toString()) < 40_000
    folder = scratch_path(spark, "wide")
    coding.write_wide(sparse, dictionary, folder)
    assert spark.read.parquet(f"{folder}/catalogue").agg(F.max("group")).first()[0] == 9_999 // coding.WIDTH
    wide = coding.read_wide(spark, folder, ["concept 00007", "concept 09999"])
    assert sorted(r.sno for r in wide.filter("`concept 00007` = 1").collect()) == [7, 10_007]
    assert wide.filter("`concept 09999` = 1").count() == 2 and wide.count() == 20_000
    with pytest.raises(ValueError):
        coding.read_wide(spark, folder)
