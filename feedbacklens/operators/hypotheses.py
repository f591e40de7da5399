"""Choice among n-best texts, output sentences, and attention export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import arrays as A, text as T


def with_average(n_best: DataFrame) -> DataFrame:
    """Add ``log_prob`` (sum) and ``avg_log_prob`` (per token, the start token included)."""
    return (
        n_best.withColumn("log_prob", A.total(F.col("log_probs")))
        .withColumn("avg_log_prob", F.col("log_prob") / F.size("log_probs"))
    )


def pick_best(n_best: DataFrame, example: str, hyp: str, min_dec_steps: int) -> DataFrame:
    """The best hypothesis of each example.

    Input has ``avg_log_prob``, ``n_tokens`` (before the stop token) and
    ``finished``.  Finished ones that are long enough come first; finished but
    short ones are discarded; unfinished ones serve when nothing else is left.
    The choice is one aggregate, so hot examples combine on the map side.
    """
    usable = n_best.filter(~F.col("finished") | (F.col("n_tokens") >= min_dec_steps))
    rest = [c for c in n_best.columns if c != example]
    best = F.max_by(F.struct(*rest), F.struct(
        F.col("finished").cast("int"), "avg_log_prob", -F.col(hyp)))
    return usable.groupBy(example).agg(best.alias("_b")).select(example, "_b.*")


def top_candidates(candidates: DataFrame, group: list[str], beam: int, tie: str) -> DataFrame:
    """The ``2 * beam`` most probable candidates per step, with log probabilities.

    Spark limits each group before the shuffle, so a hot step sends few rows.
    """
    order = Window.partitionBy(*group).orderBy(F.desc("prob"), tie)
    return (
        candidates.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= 2 * beam)
        .withColumn("log_prob", F.ln("prob"))
    )


def output_files(df: DataFrame, index: str) -> DataFrame:
    """``(index, reference_file, reference, decoded_file, decoded)`` texts per example.

    Input has ``article``, ``reference_sents`` and ``words``; generated sentences
    are cut after each period and written without a separator.
    """
    name = F.lpad(F.col(index).cast("string"), 6, "0")
    decoded = F.transform(T.period_sentences(F.array_join("words", " ")), T.html_safe)
    return df.select(
        index,
        F.concat(name, F.lit("_reference.txt")).alias("reference_file"),
        F.array_join(F.transform("reference_sents", T.html_safe), "\n").alias("reference"),
        F.concat(name, F.lit("_decoded.txt")).alias("decoded_file"),
        F.concat(F.lit("Original Feedback: "), "article",
                 F.lit(f"\n\n{T.GENERATED_MARK} \n"), F.array_join(decoded, "")).alias("decoded"),
    )


def attention_json(article: Column, decoded_words: Column, abstract: Column,
                   attention: Column, p_gens: Column | None = None) -> Column:
    """Nested JSON of one example for an attention viewer."""
    fields = [
        F.transform(T.split_space(article), T.html_safe).alias("article_lst"),
        F.transform(decoded_words, T.html_safe).alias("decoded_lst"),
        T.html_safe(abstract).alias("abstract_str"),
        attention.alias("attn_dists"),
    ]
    if p_gens is not None:
        fields.append(p_gens.alias("p_gens"))
    return F.to_json(F.struct(*fields))
