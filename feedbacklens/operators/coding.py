"""The wide 0/1 concept table with columns found in the data.

Concepts get column numbers in one pass.  A row is coded sparsely, by the column of its
concept; the wide table is a set of column groups of bounded width beside a catalogue of
names, so that no plan grows with the number of concepts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as T
from ..plans.ordering import number_rows
from ..session import cut, small_side
from .sentiment import distinct_concepts, sentiment

#: Columns of a group.
WIDTH = 256
FIXED = ["sno", "issue", "score", "sentiment_positive", "sentiment_negative", "sentiment_neutral", "sentiment_compound"]


def discover(ranked: DataFrame) -> DataFrame:
    """``(concept, column)``: all different concepts of ``ranked``, trimmed, numbered in order."""
    return number_rows(distinct_concepts(ranked).filter("concept IS NOT NULL"), "concept", name="column")


def sparse_code(ranked: DataFrame, lexicon: DataFrame, dictionary: DataFrame, **rules) -> DataFrame:
    """``(row, sno, issue, score, sentiment_…, column)``: the one column of each row that is 1.

    Sentiment is computed once per concept; concepts are looked up in a counted broadcast,
    or by a shuffle if there are too many.  Concepts the dictionary lacks have no column.
    """
    scored = sentiment(distinct_concepts(ranked), "concept", "concept", lexicon, **rules)
    scored = cut(scored.select("concept", *[
        F.col(c).alias(f"sentiment_{c}") for c in ("positive", "negative", "neutral", "compound")])
        .join(dictionary, "concept", "left"))
    rows = ranked.select("sno", F.col("label").alias("issue"), "score", T.strip(F.col("concept")).alias("concept"))
    return number_rows(rows.join(small_side(scored), "concept").select(*FIXED, "column"),
                       ["sno", "issue", "column"], name="row")


def write_wide(sparse: DataFrame, dictionary: DataFrame, folder: str, width: int = WIDTH) -> None:
    """Write ``rows`` (what is not a concept), ``groups`` and ``catalogue`` under ``folder``.

    A group holds, for the rows with a 1 in it, its ``width`` columns as one array of 0
    and 1; rows that a group lacks are 0 in all its columns.
    """
    sparse = cut(sparse)
    sparse.select("row", *FIXED).write.mode("overwrite").parquet(f"{folder}/rows")
    ones = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: (i == F.col("place")).cast("tinyint"))
    (sparse.filter("column IS NOT NULL")
     .select("row", F.floor(F.col("column") / width).cast("int").alias("group"), (F.col("column") % width).cast("int").alias("place"))
     .select("group", "row", ones.alias("cells"))
     .repartition("group", F.pmod(F.xxhash64("row"), F.lit(32))).write.mode("overwrite").partitionBy("group").parquet(f"{folder}/groups"))
    (dictionary.select("concept", F.floor(F.col("column") / width).cast("int").alias("group"),
                       (F.col("column") % width).cast("int").alias("place"))
     .write.mode("overwrite").parquet(f"{folder}/catalogue"))


def read_wide(spark: SparkSession, folder: str, concepts: Sequence[str] | None = None) -> DataFrame:
    """Rows of a wide table with the named concepts as 0/1 columns, unknown names being 0.

    Only groups with one of them are read.  Without names all concepts are columns; that
    is for tables of at most ``WIDTH`` of them.
    """
    catalogue = spark.read.parquet(f"{folder}/catalogue")
    wanted = catalogue if concepts is None else catalogue.filter(F.col("concept").isin(*concepts))
    found = wanted.limit(WIDTH + 1).collect() if concepts is None else wanted.collect()
    if concepts is None and len(found) > WIDTH:
        raise ValueError(f"more than {WIDTH} concepts: name those to read")
    places = {r.concept: (r.group, r.place) for r in found}
    names = sorted(places) if concepts is None else list(concepts)
    table = spark.read.parquet(f"{folder}/rows")
    cells = spark.read.schema("row long, cells array<tinyint>, group int").parquet(f"{folder}/groups")
    for group in sorted({g for g, _ in places.values()}):
        table = table.join(cells.filter(F.col("group") == group).select("row", F.col("cells").alias(f"_{group}")), "row", "left")
    value = lambda n: F.coalesce(F.get(f"_{places[n][0]}", F.lit(places[n][1])), F.lit(0)) if n in places else F.lit(0)
    return table.select(*FIXED, *[value(n).cast("int").alias(n) for n in names])
