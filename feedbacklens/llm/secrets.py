"""Secret scan in column expressions only: base patterns and character Markov models.

Two first-order character models, one of random strings and one of ordinary identifiers,
are counted from labelled samples; a long run of identifier characters is a secret if
the first explains it much better.  The models are integers (thousandths of a nat) in one
bounded array, so that scoring a character is one look-up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .columns import column, others, unused

#: fixed values: the base patterns, their shortest lengths, and the order of kinds
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
          r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
SHORTEST_VALUE = 6

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = "[A-Za-z0-9+/_=-]"
#: Runs that are judged, runs that teach, and how many documents teach.
JUDGED, TAUGHT, TRAIN_DOCS = 20, 8, 5000
#: Least log-likelihood ratio of a secret, in thousandths: in all, and per character.
LEAST, LEAST_EACH = 10_000, 300
_GROUP = 256
SPAN = "array<struct<start:int,kind:int,end:int>>"


def spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """All leftmost matches as ``array<struct<start, kind, end>>``, in code points.

    The pieces between matches give the positions.  Sums run over groups of matches, then
    inside each group, so that a text with very many matches is no square.  ``keep``
    drops matches by their string.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found,
        lambda piece, match: F.struct(
            F.length(piece).alias("skip"), F.length(match).alias("size"),
            (keep(match) if keep else F.lit(True)).alias("keep")))
    groups = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _GROUP).cast("int")),
        lambda g: F.slice(steps, g * _GROUP + 1, F.lit(_GROUP)))
    length = lambda g: F.aggregate(g, F.lit(0), lambda s, x: s + x["skip"] + x["size"])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("list"))
    offsets = F.aggregate(
        groups, start,
        lambda s, g: F.struct((s["at"] + length(g)).alias("at"), F.concat(s["list"], F.array(s["at"])).alias("list")),
        lambda s: s["list"])
    begin = lambda s, x: s["at"] + x["skip"]
    end = lambda s, x: s["at"] + x["skip"] + x["size"]
    inner = lambda g, at: F.aggregate(
        g, F.struct(at.alias("at"), F.array().cast(SPAN).alias("list")),
        lambda s, x: F.struct(
            end(s, x).alias("at"),
            F.when(x["keep"], F.concat(s["list"], F.array(F.struct(
                begin(s, x).alias("start"), F.lit(kind).alias("kind"), end(s, x).alias("end")))))
            .otherwise(s["list"]).alias("list")),
        lambda s: s["list"])
    return F.when(text.rlike(pattern), F.flatten(F.zip_with(groups, offsets, inner))).otherwise(
        F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Spans of the three base patterns, by start, then kind."""
    value = lambda match: F.length(F.regexp_extract(match, ASSIGN, 2)) >= SHORTEST_VALUE
    return F.array_sort(F.concat(
        spans(text, ASSIGN, 0, value), spans(text, ACCESS, 1), spans(text, HEX, 2)))


def samples(docs: DataFrame, key: str, text: str, train_docs: int) -> DataFrame:
    """``(random, value)``: labelled strings from the documents with the smallest hashed keys.

    Random are the values that base patterns find, and digests of the keys in two
    spellings; ordinary are the other runs of identifier characters.
    """
    rank = F.md5(column(key).cast("string"))
    keyed = docs.select(rank.alias("rank"), column(text).alias("text"))
    last = keyed.select("rank").filter("rank IS NOT NULL").orderBy("rank").limit(train_docs).agg(
        F.max("rank")).first()[0]
    chosen = keyed.filter(F.col("rank") <= F.lit(last))
    body = F.coalesce("text", F.lit(""))
    masked = body
    for pattern in (ASSIGN, ACCESS, HEX):
        masked = F.regexp_replace(masked, pattern, " ")
    digest = F.sha2("rank", 256)
    random = F.concat(
        F.transform(F.regexp_extract_all(body, F.lit(ASSIGN), F.lit(2)), lambda v: F.regexp_replace(v, "[.]", "")),
        F.regexp_extract_all(body, F.lit(ACCESS), F.lit(0)), F.regexp_extract_all(body, F.lit(HEX), F.lit(0)),
        F.array(F.base64(F.unhex(digest)), F.substring(digest, 1, 40)))
    ordinary = F.regexp_extract_all(masked, F.lit(f"{RUN}{{{TAUGHT},}}"), F.lit(0))
    both = chosen.select(F.explode(F.array(
        F.struct(F.lit(True).alias("random"), random.alias("found")),
        F.struct(F.lit(False).alias("random"), ordinary.alias("found")))).alias("s"))
    return both.select("s.random", F.explode("s.found").alias("value"))


def ratios(sampled: DataFrame) -> list[int]:
    """Log ratio of both models for every pair of characters, in thousandths of a nat.

    At most two counts for each pair of the alphabet reach the driver.
    """
    pairs = (sampled.filter(F.length("value") > 1)
             .select("random", "value", F.explode(F.sequence(F.lit(1), F.length("value") - 1)).alias("i"))
             .select("random", F.expr("substring(value, i, 2)").alias("pair")))
    counts = {(r.random, r.pair): r.n for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}
    size = len(ALPHABET)
    before = {(kind, a): sum(counts.get((kind, a + b), 0) for b in ALPHABET)
              for kind in (True, False) for a in ALPHABET}
    # one is added to every count: an unseen pair is rare, not impossible
    chance = lambda kind, a, b: (counts.get((kind, a + b), 0) + 1) / (before[kind, a] + size)
    return [math.floor(1000 * math.log(chance(True, a, b) / chance(False, a, b)) + 0.5)
            for a in ALPHABET for b in ALPHABET]


def llr(value: Column, table: list[int]) -> Column:
    """Log-likelihood ratio of a run, in thousandths: positive if random explains it better."""
    cells = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")
    codes = F.transform(F.split(value, ""), lambda c: F.position(c, F.lit(ALPHABET)) - 1)
    return F.aggregate(
        codes, F.struct(F.lit(-1).alias("last"), F.lit(0).alias("sum")),
        lambda s, c: F.struct(
            c.alias("last"),
            F.when(s["last"] < 0, 0).otherwise(s["sum"] + F.get(cells, s["last"] * len(ALPHABET) + c)).alias("sum")),
        lambda s: s["sum"])


def find_secrets(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                 train_docs: int = TRAIN_DOCS, out: str = "secrets") -> DataFrame:
    """Add the array column ``out`` of ``struct<start, kind, end>`` (replaced if present).

    ``kind`` is the position in ``KINDS``; ends are exclusive; spans are ordered by start,
    then kind.  Runs that touch no base span are judged by the models.  Null texts count as
    empty and have no spans; texts of any length are read whole; repeated rows get equal
    spans; an empty table stays empty; other columns are kept.
    """
    table = ratios(samples(docs, key, text, train_docs))
    body = F.coalesce(column(text), F.lit(""))
    run = f"{RUN}{{{JUDGED},}}"

    def random(match: Column) -> Column:
        score = llr(match, table)
        return (score >= LEAST) & (score >= LEAST_EACH * F.length(match))

    kept, base, more = others(docs, out), unused(docs, "_base"), unused(docs, "_more")
    found = docs.select(*kept, base_spans(body).alias(base), spans(body, run, 3, random).alias(more))
    free = F.filter(more, lambda m: ~F.exists(
        base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return found.select(*kept, F.array_sort(F.concat(base, free)).alias(out))


def listed(found: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``<key>, n_assign, n_access, n_hex, n_markov, base_sha256, spans``; see ``find_secrets``."""
    own = docs.select(column(key).alias("key"), column(text).alias("text"))
    found = find_secrets(own, key="key", text="text")
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("key").alias(key), *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(listed(F.filter("secrets", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"))


def redact(docs: DataFrame, *, key: str = "doc_id", text: str = "text", mark: str = "[secret]") -> DataFrame:
    """Replace every secret in ``text`` by ``mark``; overlapping spans are replaced together.

    Texts without secrets, null ones too, stay as they are.
    """
    made = unused(docs, "_secrets")
    found = find_secrets(docs, key=key, text=text, out=made)
    body = column(text)
    cut = lambda s, e: F.substring(body, s + 1, e - s)
    rest = F.aggregate(
        made, F.struct(F.lit(0).alias("at"), F.lit("").alias("done")),
        lambda s, x: F.when(x["end"] <= s["at"], s).otherwise(F.struct(
            x["end"].alias("at"),
            F.when(x["start"] < s["at"], s["done"])
            .otherwise(F.concat(s["done"], cut(s["at"], x["start"]), F.lit(mark))).alias("done"))),
        lambda s: F.concat(s["done"], F.substring(body, s["at"] + 1, F.length(body))))
    return found.withColumn(text, F.when(F.size(made) > 0, rest).otherwise(body)).drop(made)
