"""Readers with explicit schemas.  All of them are lazy DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as T

FEEDBACK_SCHEMA = "sno string, feedback string, label string, category string"
UNMATCHED_SCHEMA = "index long, sno long, feedback string, label string"
MATCHED_SCHEMA = "index long, sno long, feedback string, label string, concept string"
RANKED_SCHEMA = "label string, sno long, concept string, score double"
FEW_SPLITS = 16
PARAMETERS = {
    "simthreshold": float, "max_concepts": int, "labelmatch": int, "minimum_feedbacks": int,
}


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give an input with fewer partitions than cores one partition per core.

    Only an input of a few splits, a gigabyte or two, is dealt anew; larger ones stay
    where they are, whatever the number of cores.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df if splits >= min(cores, FEW_SPLITS) else df.repartition(cores, key)


def _tsv(spark: SparkSession, schema: str, header: bool):
    return (
        spark.read.schema(schema).option("sep", "\t").option("header", header)
        .option("multiLine", False).option("mode", "FAILFAST")
    )


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(feedback_file, concept_file)``: one row per concept file, null without any."""
    fields = F.split("value", "\t")
    files = F.filter(
        F.transform(F.split(F.coalesce(F.get(fields, F.lit(1)), F.lit("")), ","), T.strip),
        lambda f: f != "")
    return (
        spark.read.text(path).filter(T.strip(F.col("value")) != "")
        .select(T.strip(fields[0]).alias("feedback_file"),
                F.explode_outer(files).alias("concept_file"))
    )


def feedback(spark: SparkSession, path: str) -> DataFrame:
    """Feedback TSV with a header; the category is not kept."""
    return _tsv(spark, FEEDBACK_SCHEMA, True).csv(path).drop("category")


def concept_matrices(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Concept TSVs whose 0/1 columns differ, stacked by column name."""
    from ..operators.prepare import append

    return append([
        spark.read.option("sep", "\t").option("header", True).csv(path) for path in paths])


def unmatched(spark: SparkSession, path: str) -> DataFrame:
    """Headerless uncoded-feedback TSV; columns by position."""
    return _tsv(spark, UNMATCHED_SCHEMA, False).csv(path)


def matched(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, MATCHED_SCHEMA, False).csv(path)


def ranked_concepts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RANKED_SCHEMA).parquet(path)


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """One trimmed URL or id per line."""
    return spark.read.text(path).select(T.strip(F.col("value")).alias("url")).filter("url <> ''")


def story_files(spark: SparkSession, path: str) -> DataFrame:
    """``(story_id, story)``: one document per file, id from the file name."""
    return spark.read.text(path, wholetext=True, pathGlobFilter="*.story").select(
        F.regexp_replace(F.col("_metadata.file_name"), r"\.story$", "").alias("story_id"),
        F.col("value").alias("story"))


def records(spark: SparkSession, glob: str) -> DataFrame:
    """Model records ``(article, abstract)``; records with an empty article are skipped."""
    return spark.read.parquet(glob).filter(F.length("article") > 0)


def vocabulary(spark: SparkSession, path: str, max_size: int = 0) -> DataFrame:
    from ..operators.vocab import vocab_from_lines

    # lines of one task come in the order of the file; its tasks by where their part begins
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return vocab_from_lines(spark.read.text(path).select("value", place.alias("place")), max_size)


def word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``(word, vec)`` from lines ``word f1 … fn``."""
    fields = F.split(T.strip(F.col("value")), " ")
    return spark.read.text(path).select(
        fields[0].alias("word"),
        F.slice(fields, F.lit(2), F.size(fields) - 1).cast("array<double>").alias("vec"))


def generated_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file_name, value)`` of generated-text files, one row per file."""
    return spark.read.text(path, wholetext=True, pathGlobFilter="*_decoded.txt").select(
        F.col("_metadata.file_name").alias("file_name"), "value")


def parse_generated(files: DataFrame) -> DataFrame:
    """``(index, generated)`` from the number in the name and the text after the marker."""
    return files.select(
        T.leading_number(F.col("file_name")).alias("index"),
        T.after_marker(F.col("value")).alias("generated"),
    ).filter(F.col("generated").isNotNull())


def attach_generated(unmatched_rows: DataFrame, generated: DataFrame) -> DataFrame:
    """Uncoded feedback with its generated text, joined on the stable feedback index."""
    return unmatched_rows.join(generated, "index")


def names(spark: SparkSession, path: str) -> DataFrame:
    """Personal names, one per line, in lower case."""
    return spark.read.text(path).select(
        T.normal(F.col("value")).alias("name")).filter("name <> ''")


def parameters(spark: SparkSession, path: str) -> dict:
    """The four run parameters from a small ``name=value`` file, matched by name."""
    values = {}
    for row in spark.read.text(path).filter("value <> ''").toLocalIterator():
        name, mark, value = row.value.partition("=")
        if not mark or name not in PARAMETERS:
            raise ValueError(f"expected one of {sorted(PARAMETERS)}=<value>, got {row.value!r}")
        if not value.strip():
            raise ValueError(f"no value for {name}")
        values[name] = PARAMETERS[name](value)
    return values
