"""Token counts by a compiled finite-state transducer.

The merges of a word vocabulary are compiled, as words come, into a deterministic
transducer over bytes: a state stands for the bytes of a word read so far, and each
transition carries the change in the number of tokens that it causes (reading the
end of the word is a transition too).  White space returns it to its start state, so
the effect of a chunk of text on any state it may be entered in is short: what it
reads before its first white space, the tokens between, and what it leaves open.
Such maps compose associatively; a text is the product of its chunks' maps.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bpe import Merges
from .byte_bpe import broadcast_file
from .columns import column, others

#: fixed value: white space as Unicode defines it
BLANK = "\t-\r \x85\xa0  -     　"
WORDS = re.compile(f"[^{BLANK}]+")
CHUNK = 1 << 16
STATES = 400_000
CACHED = 200_000


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in vocabulary files of byte-level tokenizers."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Transducer:
    """Deterministic automaton over bytes whose transitions are annotated with token counts.

    States are made when first reached.  ``last`` holds, for each state, the last token of
    the bytes read; ``total`` how many tokens they make; both follow from the states
    passed on the way, by the rule that neighbours must be each other's encoding.
    """

    def __init__(self, model: dict):
        symbols = byte_symbols()
        end = model["end_of_word_suffix"] or ""
        self.inner = [symbols[b] for b in range(256)]
        self.final = [symbols[b] + end for b in range(256)]
        parts = {s: (s,) for s in [*self.inner, *self.final]}
        ranked = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            ranked.setdefault((left, right), (rank, left + right))
            parts.setdefault(left + right, parts[left] + parts[right])
        self.merges = Merges(ranked, parts)
        self.tokens = {p: t for t, p in parts.items()}
        self.longest = max(map(len, parts.values()))
        self.clear()

    def clear(self) -> None:
        self.step: dict[tuple[int, int], int] = {}
        self.ends: dict[tuple[int, int], int] = {}
        self.last: list[str] = [""]
        self.total = [0]
        self.before = [0]
        self.symbol = [""]

    def _find(self, state: int, symbol: str) -> tuple[str, int]:
        """Last token and number of tokens after reading ``symbol`` in ``state``.

        Candidates grow leftwards; exactly one fits, the one that ends a valid sequence.
        """
        path, at, fit = [symbol], state, self.merges.fit
        for _ in range(self.longest):
            token = self.tokens.get(tuple(reversed(path)))
            if token is not None and (not at or fit(self.last[at], token)):
                return token, self.total[at] + 1
            if not at:
                break
            path.append(self.symbol[at])
            at = self.before[at]
        raise ValueError(f"no token ends with {symbol!r}")

    def count(self, word: bytes) -> int:
        """Run the transducer over one word and sum what its transitions carry."""
        state, step = 0, self.step
        for byte in word[:-1]:
            key = (state, byte)
            ahead = step.get(key)
            if ahead is None:
                token, total = self._find(state, self.inner[byte])
                ahead = step[key] = len(self.last)
                self.last.append(token)
                self.total.append(total)
                self.before.append(state)
                self.symbol.append(self.inner[byte])
            state = ahead
        key = (state, word[-1])
        whole = self.ends.get(key)
        if whole is None:
            whole = self.ends[key] = self._find(state, self.final[word[-1]])[1]
        if len(self.last) > STATES:
            self.clear()  # states are made anew: memory stays bounded
        return whole


class ChunkMap(NamedTuple):
    """What a chunk does: text up to the first white space, tokens of the whole words
    behind it, and the open word at its end.  ``middle`` is None without white space."""

    head: str
    middle: int | None
    tail: str


class TokenCounter:
    def __init__(self, spec: dict):
        import regex

        _expect(spec)
        self.transducer = Transducer(spec["model"])
        self.special = re.compile("|".join(
            re.escape(t["content"]) for t in sorted(spec["added_tokens"], key=lambda t: -len(t["content"])))
            or "(?!)")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"]).findall
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.parts: dict[str, int] = {}

    def word(self, raw: str) -> int:
        """Tokens of text without white space."""
        found = self.special.findall(raw)
        if found:
            return len(found) + sum(self.word(part) for part in self.special.split(raw) if part)
        # lower-casing goes character by character, so a final sigma stays an inner one
        text = unicodedata.normalize("NFC", raw).replace("Σ", "σ").lower()
        total = 0
        for piece in self.pieces(text):
            count = self.parts.get(piece)
            if count is None:
                if len(self.parts) > CACHED:
                    self.parts.clear()
                count = self.parts[piece] = self.transducer.count(piece.encode())
            total += count
        return total

    def chunk(self, text: str) -> ChunkMap:
        words = WORDS.findall(text)
        if words and len(words[0]) == len(text):
            return ChunkMap(text, None, "")
        head = words.pop(0) if words and text.startswith(words[0]) else ""
        tail = words.pop() if words and text.endswith(words[-1]) else ""
        return ChunkMap(head, self.words(words), tail)

    def words(self, words: list[str]) -> int:
        known = self.known
        missing = {word for word in words if word not in known}
        if missing:
            if len(known) > CACHED:  # what is not used any more is forgotten: memory is bounded
                self.known, self.older, missing = {}, known, set(words)
            known, older = self.known, self.older
            for word in sorted(missing):
                count = older.get(word)
                known[word] = self.word(word) if count is None else count
        return sum(map(known.__getitem__, words))

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """First ``a``, then ``b``; associative, with the empty chunk as its unit."""
        if a.middle is None and b.middle is None:
            return ChunkMap(a.head + b.head, None, "")
        if a.middle is None:
            return ChunkMap(a.head + b.head, b.middle, b.tail)
        if b.middle is None:
            return ChunkMap(a.head, a.middle, a.tail + b.head)
        seam = a.tail + b.head
        return ChunkMap(a.head, a.middle + b.middle + (self.words([seam]) if seam else 0), b.tail)

    def scan(self, maps: list[ChunkMap]) -> ChunkMap:
        """The product of all maps, by halves: as deep as the logarithm of their number."""
        while len(maps) > 1:
            paired = [self.compose(*maps[i:i + 2]) for i in range(0, len(maps) - 1, 2)]
            maps = paired + maps[len(paired) * 2:]
        return maps[0] if maps else ChunkMap("", None, "")

    def count(self, text: str) -> int:
        whole = self.scan([self.chunk(text[i:i + CHUNK]) for i in range(0, len(text), CHUNK)])
        open_words = [w for w in (whole.head, whole.tail) if w]
        return (whole.middle or 0) + (self.words(open_words) if open_words else 0)


def _expect(spec: dict) -> None:
    """Only what this transducer compiles: anything else would be counted wrongly."""
    kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
    if (spec["model"]["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or len(splits) != 1
            or splits[0]["behavior"] != "Removed" or not splits[0]["invert"]
            or spec["model"].get("ignore_merges") or spec["model"].get("dropout")):
        raise ValueError("the file must hold a lower-casing word-end BPE tokenizer")


@lru_cache(maxsize=2)
def counter_for(file: bytes) -> TokenCounter:
    """One per worker process, kept between tasks."""
    return TokenCounter(json.loads(file))


def count_tokens(docs: DataFrame, path: str, *, text: str = "text", limit: int = 2048) -> DataFrame:
    """Add ``n_bytes, n_tokens, over_limit`` (same-named columns are replaced).

    ``path`` names a tokenizers file of the lower-casing word-end kind.  Null texts count
    as empty: 0 bytes, 0 tokens.  Texts of any length are read whole, in chunks; repeated
    rows count alike, an empty table stays empty, other columns are kept.
    """
    file = broadcast_file(docs.sparkSession, path)

    @F.arrow_udf("bigint")
    def tokens(texts: pa.Array) -> pa.Array:
        counter = counter_for(file.value)
        return pa.array([counter.count(t.as_py() or "") for t in texts], pa.int64())

    names = ["n_bytes", "n_tokens", "over_limit"]
    kept, body = others(docs, *names), column(text)
    found = docs.select(*kept, F.coalesce(F.octet_length(body), F.lit(0)).cast("long").alias("n_bytes"),
                        tokens(body).alias("n_tokens"))
    return found.select(*kept, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
