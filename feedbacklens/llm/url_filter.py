"""URL filter: host rules first, then a weighted vocabulary found by Aho-Corasick.

Strict terms carry the full weight, soft terms a part of it.  A term counts only
where no ASCII letter or digit touches it.  A url is rejected when the weights of
its distinct terms reach ``REJECT``: one strict term, or several soft ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .columns import column, others, unused

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
REJECT = 100
TERMS = {
    # strict: one is enough
    "adserver": 100, "casino": 100, "escort": 100, "malware": 100, "phishing": 100,
    "porn": 100, "spam": 100, "viagra": 100, "warez": 100, "xxx": 100,
    # soft: two strong or three weak ones are enough
    "ads": 50, "bets": 50, "betting": 50, "cheap": 50, "free": 50, "jackpot": 50,
    "pharmacy": 50, "pills": 50, "poker": 50, "replica": 50, "track": 50, "win": 50,
    "bonus": 34, "click": 34, "coupon": 34, "deal": 34, "farm": 34, "loan": 34, "promo": 34,
}


class Rule(NamedTuple):
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
HITS = "struct<n_strict:int,n_soft:int,weight:int>"
HITS_ARROW = pa.struct([("n_strict", pa.int32()), ("n_soft", pa.int32()), ("weight", pa.int32())])


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/ ? #``; empty without ``://`` or for null."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?`` or ``#``; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``struct<rule, verdict>`` of the longest fitting rule, else null."""
    found = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
               F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in sorted(rules, key=lambda r: (-len(r.host + r.path), r))
    ]
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,verdict:string>")


@lru_cache(maxsize=8)
def _automaton(terms: tuple[tuple[str, int], ...]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for term, weight in terms:
        machine.add_word(term, (len(term), term, weight))
    machine.make_automaton()
    return machine


def count_terms(url: str | None, terms: tuple[tuple[str, int], ...], reject: int) -> tuple[int, int, int]:
    """Strict occurrences, distinct soft terms, and the weight of all distinct terms of a lower-case url."""
    if not url or not terms:
        return 0, 0, 0
    text, strict, found = f" {url} ", 0, {}
    for end, (size, term, weight) in _automaton(terms).iter(text):
        if any(c.isascii() and c.isalnum() for c in (text[end - size], text[end + 1])):
            continue
        strict += weight >= reject
        found[term] = weight
    soft = sum(weight < reject for weight in found.values())
    return strict, soft, sum(found.values())


def judge_urls(pages: DataFrame, url: str = "url", *, rules: Sequence[Rule] = RULES,
               terms: Mapping[str, int] = TERMS, reject: int = REJECT) -> DataFrame:
    """Add ``host, path, rule, verdict, n_strict, n_soft, weight``; same-named columns are replaced.

    The longest fitting rule decides (ties: the first in order of verdict); else the
    vocabulary does.  A null or empty url, or one without ``://``, has empty host and
    path and is allowed unless its text holds terms.  Repeated rows are judged alike,
    an empty table stays empty, all other columns are kept.
    """
    listed = tuple(sorted(terms.items()))

    @F.arrow_udf(HITS)
    def hits(urls: pa.Array) -> pa.Array:
        rows = [count_terms(u, listed, reject) for u in urls.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array(column, pa.int32()) for column in (zip(*rows) if rows else ([], [], []))],
            fields=list(HITS_ARROW))

    names = ["host", "path", "rule", "verdict", "n_strict", "n_soft", "weight"]
    kept, found, ruled = others(pages, *names), unused(pages, "_hits"), unused(pages, "_rule")
    address = column(url)
    judged = (pages.select(*kept, host_of(address).alias("host"), path_of(address).alias("path"),
                           hits(lower_ascii(address)).alias(found))
              .withColumn(ruled, longest_rule(F.col("host"), F.col("path"), rules)))
    return judged.select(
        *kept, "host", "path", F.col(f"{ruled}.rule").alias("rule"),
        F.coalesce(f"{ruled}.verdict", F.when(F.col(f"{found}.weight") >= reject, "block").otherwise("allow"))
        .alias("verdict"),
        *[F.col(f"{found}.{name}").alias(name) for name in names[4:]])
