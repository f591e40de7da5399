"""Story documents and model records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text as T
from ..functions.arrays import pin
from ..plans.ordering import number_rows


def make_stories(df: DataFrame, mode: str = "training") -> DataFrame:
    """Add ``story``: the feedback, a blank line, the highlight mark, the concept."""
    concept = F.col("concept") if mode == "training" else F.lit(T.CONCEPT_PLACEHOLDER)
    return df.withColumn(
        "story",
        F.concat(F.col("feedback"), F.lit(f"\n\n{T.HIGHLIGHT}\n"), concept),
    )


def story_lines(story) -> "F.Column":
    """Lower-case cleaned lines with closing marks."""
    return F.transform(
        F.split(story, "\n"),
        lambda line: T.close_line(T.drop_literals(F.lower(T.strip(line)), T.STORY_OMIT)),
    )


def parse_stories(df: DataFrame) -> DataFrame:
    """Replace ``story`` by ``article`` and ``abstract`` (tagged highlights)."""
    is_mark = lambda line: line.startswith(T.HIGHLIGHT)
    lines, first = F.col("_lines"), F.col("_first")
    before = F.when(first == 0, lines).otherwise(F.slice(lines, F.lit(1), first - 1))
    after = F.when(first == 0, F.array().cast("array<string>")).otherwise(
        F.slice(lines, first, F.size(lines)))
    return (
        pin(df, _lines=F.filter(story_lines(F.col("story")), lambda l: l != ""))
        .withColumn("_first",
                    F.array_position(F.transform(F.col("_lines"), is_mark), True).cast("int"))
        .withColumn("article", F.array_join(before, " "))
        .withColumn("abstract", T.tag_sentences(F.filter(after, lambda l: ~is_mark(l))))
        .drop("_lines", "_first", "story")
    )


def priority_lookup(ids: DataFrame, store_a: DataFrame, store_b: DataFrame, key: str,
                    value: str, require: bool = False) -> DataFrame:
    """Look ``key`` up in store A, then in store B; add ``value`` and ``store``.

    ``store`` is null for a key in neither; with ``require`` such a key fails
    the job.  Each store has one row per key.
    """
    a = store_a.select(key, F.col(value).alias("_a"), F.lit(True).alias("_in_a"))
    b = store_b.select(key, F.col(value).alias("_b"), F.lit(True).alias("_in_b"))
    store = F.when(F.col("_in_a"), "a").when(F.col("_in_b"), "b")
    if require:
        store = F.coalesce(store, F.raise_error(
            F.concat(F.lit("document in neither store: "), F.col(key))))
    return (
        ids.join(a, key, "left").join(b, key, "left")
        .withColumn("store", store)
        .withColumn(value, F.when(F.col("_in_a"), F.col("_a")).otherwise(F.col("_b")))
        .drop("_a", "_b", "_in_a", "_in_b")
    )


def usable_records(df: DataFrame) -> DataFrame:
    """Records with a non-empty article."""
    return df.filter(F.length("article") > 0)


def build_records(ids: DataFrame, store_a: DataFrame, store_b: DataFrame) -> DataFrame:
    """``(url, article, abstract)`` for listed URLs; stores hold ``(story_id, story)``."""
    keyed = ids.withColumn("story_id", T.sha1_key(F.col("url")))
    found = priority_lookup(keyed, store_a, store_b, "story_id", "story", require=True)
    return usable_records(parse_stories(found.drop("store")))


def chunk_records(df: DataFrame, key: str, rows: int = 1_000) -> DataFrame:
    """Add ``chunk``: consecutive groups of ``rows`` records in key order."""
    return (
        number_rows(df, key)
        .withColumn("chunk", F.floor(F.col("row_index") / rows).cast("long"))
        .drop("row_index")
    )
