"""Words of many texts at once, as numbers: no Python object per word is made."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

RUN_BYTES = 2_000_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
#: the low ``i`` bytes of a number
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


class Words(NamedTuple):
    """Words in order of the text: ``doc`` (position of its text in the run), where the word
    starts and how long it is in bytes, ``head``, its first eight bytes, and its ``key``."""

    doc: np.ndarray
    start: np.ndarray
    size: np.ndarray
    head: np.ndarray
    key: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def first_bytes(head: np.ndarray, count: int) -> np.ndarray:
    return head & _MASK[count]


def runs(texts: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(bytes, ends)`` of consecutive texts, about ``limit`` bytes each; nulls are empty."""
    chunk, size = [], 0
    for text in texts:
        data = (text.as_py() or "").encode()
        chunk.append(data)
        size += len(data)
        if size >= limit:
            yield _joined(chunk)
            chunk, size = [], 0
    if chunk:
        yield _joined(chunk)


def _joined(chunk: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    # a blank behind each text keeps words of neighbours apart
    data = np.frombuffer(b" ".join([*chunk, b""]), np.uint8)
    return data, np.cumsum([len(c) + 1 for c in chunk])


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and for the two-byte capitals of Latin-1."""
    low = _LOWER[data]
    capital = (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97) & (low[:-1] == 0xC3)
    low[1:][capital] += 32
    return low


def words(data: np.ndarray, ends: np.ndarray) -> Words:
    """Runs of ASCII letters, digits and non-ASCII characters, in lower case.

    A key is made of a word's first sixteen bytes, its last eight and its length.
    """
    low = lowered(data)
    inside = np.zeros(len(low) + 1, np.int8)
    inside[1:] = _IS_WORD[low]
    change = np.diff(inside)
    starts = np.flatnonzero(change == 1)
    stops = np.flatnonzero(change == -1)  # every text ends in a blank, so each word stops
    size = stops - starts
    padded = np.concatenate([np.zeros(8, np.uint8), low, np.zeros(16, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)

    def load(at: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(eight[at + 8]).view("<u8").reshape(-1).astype(np.uint64)

    head = load(starts) & _MASK[np.minimum(size, 8)]
    key = mix(head + (size.astype(np.uint64) << np.uint64(56)))
    long = np.flatnonzero(size > 8)
    more = load(starts[long] + 8) & _MASK[np.minimum(size[long] - 8, 8)]
    key[long] = mix(key[long] ^ more)
    long = np.flatnonzero(size > 16)
    key[long] = mix(key[long] ^ load(stops[long] - 8))
    return Words(np.searchsorted(ends, starts, side="right"), starts, size, head, key)
