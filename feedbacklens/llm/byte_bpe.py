"""Byte-level BPE by prefix dynamic programming, and decoding.

``PrefixEncoder`` keeps, for every byte prefix of a piece, the one valid last
token.  A longer text extends the list, an edit drops only the entries behind it;
the encoding is read by stepping back from the end.  The tokens that may end at a
byte come from a state machine over the beginnings of tokens, built as it is met.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from .bpe import Merges
from .columns import column, others, unused

CACHED = 100_000
REMEMBERED = 250_000
ASTRAL = re.compile("[\U00010000-\U0010ffff]")
#: fixed value: the pattern that the public rank files are used with
PUBLIC_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DIGEST = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """A rank file: base64 token and rank on each line."""
    pairs = (line.split() for line in lines.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class State:
    """The longest end of a text that some token begins with."""

    __slots__ = ("name", "ends", "next")

    def __init__(self, name: bytes, ends: tuple[tuple[int, int, dict[int, bool]], ...]):
        self.name = name
        #: the tokens that end here, longest first: length, rank, and what may stand before
        self.ends = ends
        self.next: dict[int, State] = {}


class PrefixEncoder:
    """Encodes one piece after another, keeping what the next shares with the last.

    The tokens that may end at a byte follow from the longest end of the text that some
    token begins with (a state): what a byte makes of a state, and which tokens fit side by
    side, is worked out once and remembered.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.beginnings = {token[:end] for token in ranks for end in range(len(token) + 1)} | {b""}
        self.merges = Merges(_Ranked(ranks), {})
        self.states: dict[bytes, State] = {}
        self.forget()

    def forget(self) -> None:
        """Start anew, without a text and with nothing remembered."""
        self.text = b""
        #: for every prefix of the text its last token, and its state
        self.last: list[int] = []
        self.path: list[State] = []
        self.start = State(b"", ())
        for state in self.states.values():
            state.next.clear()  # they refer to each other: freed at once like this
        self.states = {b"": self.start}
        self.n_steps = 0
        #: for each token those that were asked for on its left
        self.fits: dict[int, dict[int, bool]] = {}
        self.n_fits = 0
        self._halves: dict[bytes, tuple[bytes, ...] | None] = {}

    def step(self, state: State, byte: int) -> State:
        """The state after one more byte."""
        name, ranks = state.name + bytes((byte,)), self.ranks
        while name not in self.beginnings:
            name = name[1:]
        found = self.states.get(name)
        if found is None:
            ends = (name[start:] for start in range(len(name)) if name[start:] in ranks)
            found = self.states[name] = State(
                name, tuple((len(end), ranks[end], self.fits.setdefault(ranks[end], {})) for end in ends))
        self.n_steps += 1
        if self.n_steps > REMEMBERED:  # clearing costs time only, here and below
            for known in self.states.values():
                known.next.clear()
            self.n_steps = 1
        state.next[byte] = found
        return found

    def halves(self, token: bytes) -> tuple[bytes, ...] | None:
        """The two tokens that merging makes ``token`` of at last, nothing for a single byte;
        None if merging does not make it, or not by merges of rising rank."""
        if token in self._halves:
            return self._halves[token]
        parts, rank = [token[i:i + 1] for i in range(len(token))], -1.0
        while len(parts) > 2:
            before, (rank, at) = rank, min(
                (self.ranks.get(a + b, math.inf), i) for i, (a, b) in enumerate(pairwise(parts)))
            if not before <= rank < math.inf:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        found = None if len(parts) > 2 or rank > self.ranks[token] else tuple(parts) if len(parts) == 2 else ()
        self._halves[token] = found
        return found

    def fit(self, left: bytes, right: bytes) -> bool:
        """Whether the text of ``left`` + ``right`` is encoded as just these two.

        The merges of both are taken back, the latest first; they do not fit if what then
        meets in the middle would have been merged before that.
        """
        if self.halves(left) is None or self.halves(right) is None:
            return self.merges.merge([bytes((byte,)) for byte in left + right]) == [left, right]
        ranks, limit = self.ranks, math.inf
        while ranks.get(left + right, math.inf) >= limit:
            made = ranks[left] if len(left) > 1 else -1, ranks[right] if len(right) > 1 else -1
            if made[0] > made[1]:
                limit, left = made[0], self.halves(left)[1]
            elif len(right) > 1:
                limit, right = made[1] + 1, self.halves(right)[0]
            else:
                return True
        return False

    def resume(self, text: bytes, keep: int) -> None:
        """Make ``text`` the current text, its first ``keep`` bytes being unchanged."""
        self.text = text
        last, path = self.last, self.path
        del last[keep:], path[keep:]
        state = path[-1] if keep else self.start
        for end, byte in enumerate(text[keep:], keep):
            state = state.next.get(byte) or self.step(state, byte)
            for size, token, fits in state.ends:
                if size > end:  # the whole prefix
                    break
                left = last[-size]
                good = fits.get(left)
                if good is None:
                    good = self.ask(left, token, fits)
                if good:
                    break
            else:
                raise ValueError(f"no token ends at byte {end + 1}: the ranks lack a single byte")
            last.append(token)
            path.append(state)

    def ask(self, left: int, right: int, fits: dict[int, bool]) -> bool:
        self.n_fits += 1
        if self.n_fits > REMEMBERED:
            for known in self.fits.values():
                known.clear()
            self.n_fits = 1
        fits[left] = good = self.fit(self.bytes[left], self.bytes[right])
        return good

    def append(self, more: bytes) -> None:
        self.resume(self.text + more, len(self.last))

    def edit(self, start: int, end: int, new: bytes) -> None:
        """Replace bytes ``start`` to ``end``; only prefixes behind ``start`` are done again."""
        self.resume(self.text[:start] + new + self.text[end:], min(start, len(self.last)))

    def tokens(self) -> list[int]:
        if self.text in self.ranks:  # as the library does, whatever the merges say
            return [self.ranks[self.text]]
        found, end = [], len(self.text)
        while end:
            token = self.last[end - 1]
            found.append(token)
            end -= len(self.bytes[token])
        return found[::-1]

    def encode(self, text: bytes) -> list[int]:
        keep = 0
        for old, new in zip(self.text, text):
            if old != new:
                break
            keep += 1
        self.resume(text, keep)
        return self.tokens()


class _Ranked:
    """Pairs of byte strings by the rank of what they make together."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def get(self, pair: tuple[bytes, bytes]) -> tuple[int, bytes] | None:
        whole = pair[0] + pair[1]
        rank = self.ranks.get(whole)
        return None if rank is None else (rank, whole)


def ranges(category: str) -> list[tuple[int, int]]:
    """First and last code point of each run of a character category such as ``\\p{L}``."""
    import regex

    points = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    return [(ord(m[0][0]), ord(m[0][-1])) for m in regex.finditer(f"{category}+", points)]


@lru_cache(maxsize=4)
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of the pattern in a text.

    The public pattern is matched by the standard library where a text stays in the
    basic plane, which takes half the time; its alternatives exclude each other by
    their first character, except at the apostrophe, so letters may come first.
    """
    import regex

    slow = regex.compile(pattern).findall
    if pattern != PUBLIC_PATTERN:
        return slow
    letters, numbers, blanks = (
        "".join(f"\\u{a:04x}-\\u{min(z, 0xFFFF):04x}" for a, z in ranges(c) if a <= 0xFFFF)
        for c in (r"\p{L}", r"\p{N}", r"\s"))
    fast = re.compile(
        rf" ?[{letters}]+| ?[{numbers}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{blanks}{letters}{numbers}]+"
        rf"|[{blanks}]+(?![^{blanks}])|[{blanks}]+").findall
    return lambda text: fast(text) if text.isascii() or not ASTRAL.search(text) else slow(text)


class TextEncoder:
    """Whole texts: pieces by the pattern, each encoded once while it is remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoder = PrefixEncoder(ranks)
        self.pieces = splitter(pattern)
        self.bytes = self.encoder.bytes
        self.known: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def record(self, ids: list[int]) -> tuple:
        """What is remembered of a piece."""
        return tuple(ids)

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces not yet known, in order, so that neighbours share prefixes.

        What the last ``CACHED`` pieces did not use is forgotten: that bounds memory and
        costs time only.
        """
        if len(self.known) > CACHED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        missing = pieces.difference(known)
        again = missing.intersection(older)
        known.update(zip(again, map(older.__getitem__, again)))
        for piece in sorted(missing.difference(again)):
            known[piece] = self.record(self.encoder.encode(piece.encode()))

    def recorded(self, texts: list[str]) -> Iterator[Iterator[tuple]]:
        """For each text what is remembered of its pieces, in order."""
        cuts = [self.pieces(text) for text in texts]
        self.learn(set(chain.from_iterable(cuts)))
        return (map(self.known.__getitem__, pieces) for pieces in cuts)

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return [list(chain.from_iterable(found)) for found in self.recorded(texts)]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def forget(self) -> None:
        """Give back what the texts so far have left, at the end of a task."""
        self.known, self.older = {}, {}
        self.encoder.forget()
        pa.default_memory_pool().release_unused()


class DigestEncoder(TextEncoder):
    """Remembers each piece's ids in digits and the bytes that they decode to: a text's are theirs joined."""

    def record(self, ids: list[int]) -> tuple[str, bytes]:
        return " ".join(map(str, ids)), self.decode(ids)

    def digest_all(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        for found in map(list, self.recorded(texts)):
            ids = " ".join([digits for digits, _ in found if digits])
            decoded = b"".join([piece for _, piece in found])
            yield (ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
                   hashlib.sha256(decoded).hexdigest())


@lru_cache(maxsize=2)
def encoder_for(lines: bytes, pattern: str, kind: type[TextEncoder] = TextEncoder) -> TextEncoder:
    """One per worker process: its tables are built once."""
    return kind(read_ranks(lines), pattern)


def broadcast_file(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary file (about a megabyte, whatever the corpus) for every executor."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def groups(texts: Iterable[pa.StringScalar], limit: int = 2_000_000) -> Iterable[list[str]]:
    """Texts in runs of about ``limit`` characters; null counts as empty."""
    run, size = [], 0
    for text in texts:
        run.append(text.as_py() or "")
        size += len(run[-1])
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode_texts(docs: DataFrame, path: str, *, pattern: str = PUBLIC_PATTERN, text: str = "text",
                 ids: str = "token_ids", same: str = "round_trip") -> DataFrame:
    """Add the array column ``ids`` and, in the same pass, whether decoding gives the text
    again (columns of these names are replaced); null and empty texts have no ids.

    Any length and any characters are encoded as the public library would; repeated
    rows get equal ids, an empty table stays empty, other columns are kept.
    """
    file = broadcast_file(docs.sparkSession, path)
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("same", pa.bool_())])

    @F.arrow_udf("struct<ids:array<int>,same:boolean>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = encoder_for(file.value, pattern)
        for texts in batches:
            for run in groups(texts):
                rows = encoder.encode_all(run)
                same = [encoder.decode(row) == text.encode() for row, text in zip(rows, run)]
                # one run at a time: what waits between Python and the JVM stays small
                yield pa.StructArray.from_arrays(
                    [pa.array(rows, pa.list_(pa.int32())), pa.array(same)], fields=list(kind))
        encoder.forget()

    kept, made = others(docs, ids, same), unused(docs, "_encoded")
    return docs.select(*kept, encode(column(text)).alias(made)).select(
        *kept, F.col(f"{made}.ids").alias(ids), F.col(f"{made}.same").alias(same))


def decode_ids(docs: DataFrame, path: str, *, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """Add the binary column ``decoded`` (replaced if present); null arrays give empty bytes.

    An id that the vocabulary lacks ends the job with a message naming it.
    """
    file = broadcast_file(docs.sparkSession, path)

    @F.arrow_udf("binary")
    def decode(rows: pa.Array) -> pa.Array:
        encoder = encoder_for(file.value, PUBLIC_PATTERN)
        return pa.array([encoder.decode(row or ()) for row in rows.to_pylist()], pa.binary())

    return docs.withColumn(decoded, decode(column(ids)))


def encoded_digest(docs: DataFrame, path: str, *, pattern: str = PUBLIC_PATTERN,
                   text: str = "text") -> DataFrame:
    """Add ``n_tokens, ids_sha256, decoded_sha256`` (replaced if present) to every row.

    Encodes, decodes the ids again and hashes both inside one pass, so that neither ids
    nor bytes leave the task.  Null and empty texts have no tokens and the hash of nothing.
    """
    file = broadcast_file(docs.sparkSession, path)

    names = ["n_tokens", "ids_sha256", "decoded_sha256"]

    @F.arrow_udf(DIGEST)
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = encoder_for(file.value, pattern, DigestEncoder)
        for texts in batches:
            rows = list(chain.from_iterable(map(encoder.digest_all, groups(texts))))
            yield pa.StructArray.from_arrays(
                [pa.array([row[i] for row in rows], kind)
                 for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))], names=names)
        encoder.forget()

    kept, made = others(docs, *names), unused(docs, "_digest")
    found = docs.select(*kept, digest(column(text)).alias(made))
    return found.select(*kept, *[F.col(f"{made}.{name}").alias(name) for name in names])
