"""Mixing sources to target weights by hierarchical budgeting.

Sources hang below languages, languages below domains.  A token budget is handed down
the tree by weight.  A branch that cannot use its share, because its documents, read
``max_epochs`` times, have fewer tokens, leaves the rest to its siblings; only what a
whole family cannot use goes to the families beside it.  Each source then gives its
documents in the seeded order of one epoch after the other, up to its quota.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut
from .columns import column, others

#: Weights by name; what is not named has weight 1.  A domain is the family of a source.
DOMAIN_WEIGHTS = {"d0": 3, "d1": 2, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}
SOURCE_WEIGHTS: dict[str, int] = {}
BUDGET_SHARE, MAX_EPOCHS, SEED = 0.5, 2, 17
#: Hashed places of a document inside its source's epoch: whole places are taken or left,
#: only the place where the quota ends is looked into.
PLACES = 4096
#: Rows of the plan (sources) up to which it is sent to every task.
PLANNED = 100_000
LEAF = ["domain", "lang", "source"]


def word_count(text: Column) -> Column:
    """Number of runs without white space: the default measure of tokens."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def domain_of(source: Column) -> Column:
    """The default domain: the number at a source's end, modulo 4; without one, ``d0``."""
    number = F.coalesce(F.regexp_extract(source, "([0-9]{1,9})$", 1).try_cast("long"), F.lit(0))
    return F.concat(F.lit("d"), (number % 4).cast("string"))


def _weights(name: Column, given: dict[str, int]) -> Column:
    if not given:
        return F.lit(1)
    table = F.create_map(*[F.lit(x) for pair in sorted(given.items()) for x in pair])
    return F.coalesce(table[name], F.lit(1))


def fill(nodes: DataFrame, family: list[str]) -> DataFrame:
    """Share ``budget`` of each family among its members by ``weight``, up to ``cap``.

    Members are taken in order of ``cap / weight``: as long as a member's part of what is
    left covers its cap it gets just that, and its surplus stays for those behind it; the
    others divide the rest by weight, rounded down.  Adds ``quota``.
    """
    order = Window.partitionBy(*family).orderBy(F.col("cap") / F.col("weight"), "name")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.greatest(F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)), F.lit(0))
    with_left = nodes.withColumn("_left", left).withColumn("_weight", F.sum("weight").over(onward))
    full = with_left.withColumn("_full", F.col("cap") * F.col("_weight") <= F.col("_left") * F.col("weight"))
    whole = Window.partitionBy(*family)
    return (full.withColumn("_rest", F.min(F.when(~F.col("_full"), F.struct(
                F.col("cap") / F.col("weight"), "name", F.col("_left").alias("left"), F.col("_weight").alias("w")))).over(whole))
            .withColumn("quota", F.when(F.col("_full"), F.col("cap")).otherwise(
                F.floor(F.col("_rest.left") * F.col("weight") / F.col("_rest.w"))).cast("long"))
            .drop("_left", "_weight", "_full", "_rest"))


def quotas(leaves: DataFrame, budget: Column, max_epochs: int, *, domain_weights: dict[str, int],
           lang_weights: dict[str, int], source_weights: dict[str, int]) -> DataFrame:
    """``domain, lang, source, total, quota`` from leaves ``(domain, lang, source, total)``.

    The tree has a row per source, language and domain; nothing here sees a document.
    """
    named = (leaves.withColumn("cap", F.col("total") * max_epochs).withColumn("root", F.lit(0)))
    domains = named.groupBy("root", "domain").agg(F.sum("cap").alias("cap"), F.sum("total").alias("total"))
    domains = domains.withColumn("budget", F.floor(F.sum("total").over(Window.partitionBy("root")) * budget).cast("long"))
    domains = fill(domains.withColumn("name", F.col("domain"))
                   .withColumn("weight", _weights(F.col("domain"), domain_weights)), ["root"])
    langs = named.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"))
    langs = langs.join(domains.select("domain", F.col("quota").alias("budget")), "domain")
    langs = fill(langs.withColumn("name", F.col("lang"))
                 .withColumn("weight", _weights(F.col("lang"), lang_weights)), ["domain"])
    sources = named.join(langs.select("domain", "lang", F.col("quota").alias("budget")), ["domain", "lang"])
    sources = fill(sources.withColumn("name", F.col("source"))
                   .withColumn("weight", _weights(F.col("source"), source_weights)), ["domain", "lang"])
    return sources.select("domain", "lang", "source", "total", "quota")


def mix_sources(docs: DataFrame, *, key: str = "doc_id", lang: str = "lang", source: str = "source",
                tokens: str = "tokens", budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS,
                seed: int = SEED, domain_weights: dict[str, int] | None = None,
                lang_weights: dict[str, int] | None = None,
                source_weights: dict[str, int] | None = None) -> DataFrame:
    """The chosen documents, one row per epoch they are read in, with all their columns and
    ``domain`` and ``epoch`` (from 1; same-named columns are replaced).

    The budget is ``budget_share`` of all tokens.  In an epoch documents come in the order of
    ``md5(seed:epoch:key)``, then key; a source takes them as long as the tokens before them
    are fewer than its quota, so it ends at most one document above it.  Null languages and
    sources are branches of their own, named by the empty text; null or negative token counts
    are 0, and a document without tokens comes along where its place is reached.  A null key
    hashes as the empty text; equal keys share a place and are taken in order of their other
    columns' hash; an empty table stays empty.  A source may hold a third of all rows: its
    order is cut into ``PLACES`` hashed places that are summed first, and only the one where
    the quota ends is sorted.
    """
    name = lambda c: F.coalesce(column(c).cast("string"), F.lit(""))
    leaf = docs.select(
        domain_of(name(source)).alias("domain"), name(lang).alias("lang"), name(source).alias("source"),
        F.greatest(F.coalesce(column(tokens).cast("long"), F.lit(0)), F.lit(0)).alias("n"),
        column(key).cast("string").alias("key"), F.struct(*others(docs, "domain", "epoch")).alias("row"))
    totals = cut(leaf.groupBy(*LEAF).agg(F.sum("n").alias("total")))
    plan = cut(quotas(totals, F.lit(budget_share), max_epochs,
                      domain_weights=DOMAIN_WEIGHTS if domain_weights is None else domain_weights,
                      lang_weights=LANG_WEIGHTS if lang_weights is None else lang_weights,
                      source_weights=SOURCE_WEIGHTS if source_weights is None else source_weights))
    epoch = F.sequence(F.lit(1), F.ceil(F.col("quota") / F.greatest("total", F.lit(1))).cast("int"))
    epochs = plan.filter("quota > 0").withColumn("epoch", F.explode(epoch)).select(
        *LEAF, "epoch", (F.col("quota") - (F.col("epoch") - 1) * F.col("total")).alias("quota"), "total")
    small = F.broadcast if plan.count() <= PLANNED else lambda df: df
    rank = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.coalesce("key", F.lit(""))))
    placed = (leaf.join(small(epochs), LEAF).withColumn("rank", rank)
              .withColumn("place", F.conv(F.substring("rank", 1, 3), 16, 10).cast("int"))
              .withColumn("whole", F.col("quota") >= F.col("total")))
    turn = [*LEAF, "epoch"]
    running = Window.partitionBy(*turn).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    edges = cut(placed.filter("NOT whole").groupBy(*turn, "place").agg(
                    F.sum("n").alias("n"), F.min("quota").alias("quota"))
                .withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0)))
                .filter("before < quota")
                .groupBy(*turn).agg(F.max_by(F.struct("place", "before"), "place").alias("edge")))
    near = placed.join(small(edges), turn, "left")
    inside = near.filter(F.col("whole") | (F.col("place") < F.col("edge.place")))
    order = Window.partitionBy(*turn).orderBy("rank", "key", F.xxhash64("row")).rowsBetween(
        Window.unboundedPreceding, -1)
    last = (near.filter(~F.col("whole") & (F.col("place") == F.col("edge.place")))
            .withColumn("passed", F.col("edge.before") + F.coalesce(F.sum("n").over(order), F.lit(0)))
            .filter("passed < quota"))
    return inside.select("row", "domain", "epoch").union(last.select("row", "domain", "epoch")).select(
        "row.*", "domain", "epoch")
