"""Lexicon sentiment and the binary-coded concept matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as T
from ..session import small_side

# Fixed values of the published scoring rule.
NORMAL_ALPHA = 15.0
NEGATION = -0.74
BOOST = 0.293
BOOST_DECAY = (1.0, 0.95, 0.9)
CAPITALS = 0.733
EXCLAMATION, MOST_EXCLAMATIONS = 0.292, 4
QUESTION, MOST_QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96
NEGATORS = ["not", "no", "never", "none", "nor", "cannot", "can't", "don't", "isn't",
            "wasn't", "won't", "without"]
BOOSTERS = ["absolutely", "completely", "extremely", "highly", "most", "more", "really",
            "so", "totally", "very"]
DAMPENERS = ["almost", "barely", "hardly", "less", "little", "partly", "slightly", "somewhat"]
CONTRAST = ["but"]


def _sign(value: Column) -> Column:
    return F.when(value < 0, -1.0).otherwise(1.0)


def sentiment(df: DataFrame, key: str, column: str, lexicon: DataFrame,
              negators: Sequence[str] = NEGATORS, boosters: Sequence[str] = BOOSTERS,
              dampeners: Sequence[str] = DAMPENERS,
              contrast: Sequence[str] = CONTRAST) -> DataFrame:
    """``(key, positive, negative, neutral, compound)`` per text.

    ``lexicon`` holds ``(word, valence)``.  Boosters and negators count within
    the three preceding words, capitals when the text is not all capitals, words
    before a contrast word half and after it one and a half times, and
    exclamation and question marks raise the total.
    """
    words = T.words(F.col(column))
    upper = F.size(F.filter(words, T.is_upper))
    marks = lambda c: F.length(F.regexp_replace(column, f"[^{c}]", ""))
    docs = df.select(
        key, words.alias("_words"),
        ((upper > 0) & (upper < F.size(words))).alias("_mixed"),
        (F.least(marks("!"), F.lit(MOST_EXCLAMATIONS)) * EXCLAMATION
         + F.when(marks("?") > MOST_QUESTIONS, MANY_QUESTIONS)
         .when(marks("?") > 1, marks("?") * QUESTION).otherwise(0.0)).alias("_marks"),
    )
    side = small_side(lexicon)
    rows = (
        docs.select(key, "_mixed", "_marks", F.posexplode_outer("_words").alias("_pos", "_token"))
        .withColumn("word", F.lower("_token"))
        .join(side.select("word", F.col("valence").cast("double").alias("_base")), "word", "left")
        .repartition(key)
    )
    order = Window.partitionBy(key).orderBy("_pos")
    turn = F.when(F.col("word").isin(list(contrast)), F.col("_pos"))
    rows = rows.select(
        key, "_pos", "_token", "_mixed", "_marks", "_base",
        F.min(turn).over(Window.partitionBy(key)).alias("_turn"),
        *[F.lag("word", n).over(order).alias(f"_w{n}") for n in (1, 2, 3)],
        *[F.lag("_base", n).over(order).alias(f"_v{n}") for n in (1, 2, 3)],
    )
    loud = F.when(F.col("_mixed") & T.is_upper(F.col("_token")), CAPITALS).otherwise(0.0)
    valence = F.col("_base") + _sign(F.col("_base")) * loud
    strength = None
    for n, decay in zip((1, 2, 3), BOOST_DECAY):
        word, plain = F.col(f"_w{n}"), F.col(f"_v{n}").isNull()
        step = (
            F.when(plain & word.isin(list(boosters)), BOOST * decay)
            .when(plain & word.isin(list(dampeners)), -BOOST * decay).otherwise(0.0)
        )
        strength = step if strength is None else strength + step
    valence = valence + _sign(valence) * strength
    for n in (1, 2, 3):
        negated = F.col(f"_v{n}").isNull() & F.col(f"_w{n}").isin(list(negators))
        valence = valence * F.when(negated, NEGATION).otherwise(1.0)
    valence = valence * F.when(F.col("_pos") < F.col("_turn"), 0.5).when(
        F.col("_pos") > F.col("_turn"), 1.5).otherwise(1.0)
    value = F.coalesce(F.col("_value"), F.lit(0.0))
    sums = rows.withColumn("_value", valence).groupBy(key).agg(
        F.sum(value).alias("_sum"),
        F.sum(F.when(value > 0, value + 1).otherwise(0.0)).alias("_pos_sum"),
        F.sum(F.when(value < 0, value - 1).otherwise(0.0)).alias("_neg_sum"),
        F.count_if(F.col("_pos").isNotNull() & (value == 0)).alias("_neu"),
        F.max("_marks").alias("_marks"),
    )
    total = F.col("_sum") + F.when(F.col("_sum") == 0, 0.0).otherwise(
        _sign(F.col("_sum")) * F.col("_marks"))
    pos, neg = F.col("_pos_sum"), F.abs("_neg_sum")
    stronger = F.col("_marks")
    pos = pos + F.when(pos > neg, stronger).otherwise(0.0)
    neg = neg + F.when(F.col("_pos_sum") < F.abs("_neg_sum"), stronger).otherwise(0.0)
    whole = pos + neg + F.col("_neu")
    share = lambda x: F.when(whole == 0, 0.0).otherwise(F.round(x / whole + 1e-9, 3))
    return sums.select(
        key, share(pos).alias("positive"), share(neg).alias("negative"),
        share(F.col("_neu")).alias("neutral"),
        (F.round(total / F.sqrt(total * total + NORMAL_ALPHA) + 1e-9, 4) + 0.0).alias("compound"))


def distinct_concepts(ranked: DataFrame) -> DataFrame:
    return ranked.select(T.strip(F.col("concept")).alias("concept")).distinct()


def binary_code(ranked: DataFrame, lexicon: DataFrame,
                concepts: Sequence[str], **rules) -> DataFrame:
    """One row per (sno, label, concept): score, sentiment, and 0/1 concept columns.

    Exactly one column is 1 in each row.  ``concepts`` names the columns; they
    are few by design (``max_concepts`` per label).  Sentiment is computed once
    per distinct concept.
    """
    ranked = ranked.withColumn("concept", T.strip(F.col("concept")))
    scored = sentiment(
        distinct_concepts(ranked), "concept", "concept", lexicon, **rules)
    scored = scored.select("concept", *[
        F.col(c).alias(f"sentiment_{c}") for c in ("positive", "negative", "neutral", "compound")])
    return ranked.join(scored, "concept").select(
        "sno", F.col("label").alias("issue"), "score", "sentiment_positive",
        "sentiment_negative", "sentiment_neutral", "sentiment_compound",
        *[(F.col("concept") == c).cast("int").alias(c) for c in concepts])
