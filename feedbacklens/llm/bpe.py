"""Byte-pair merges and the test whether two tokens may stand side by side.

Both token operators rest on one property of byte-pair encoding: a sequence of
tokens is the encoding of its own text exactly if every two neighbours are the
encoding of theirs.  So each prefix of a text has one valid last token.
"""

from __future__ import annotations

from collections.abc import Hashable, Sequence


class Merges:
    """A merge table over any symbols: bytes for rank files, ids for merge lists.

    ``ranked`` maps a pair of neighbouring tokens to ``(rank, merged token)``.
    """

    def __init__(self, ranked: dict[tuple[Hashable, Hashable], tuple[int, Hashable]],
                 symbols: dict[Hashable, tuple[Hashable, ...]]):
        self.ranked = ranked
        #: the single symbols that each token consists of
        self.symbols = symbols
        self._fits: dict[tuple[Hashable, Hashable], bool] = {}

    def merge(self, parts: Sequence[Hashable]) -> list[Hashable]:
        """Plain merging, lowest rank first, leftmost first."""
        parts = list(parts)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.ranked.get((parts[i], parts[i + 1]))
                if found is not None and (best is None or found[0] < best[0]):
                    best, at = found, i
            if best is None:
                break
            parts[at:at + 2] = [best[1]]
        return parts

    def forget(self) -> None:
        self._fits = {}

    def fit(self, left: Hashable, right: Hashable) -> bool:
        """Whether the text of ``left`` + ``right`` is encoded as just these two."""
        pair = (left, right)
        known = self._fits.get(pair)
        if known is None:
            if len(self._fits) > 250_000:
                self._fits.clear()  # a memo: clearing costs time only
            known = self.merge(self.symbols[left] + self.symbols[right]) == [left, right]
            self._fits[pair] = known
        return known
