"""Hashed words and character n-grams of texts, computed on whole byte arrays at once.

A text is brought to words with one space around each. An n-gram is a run of ``n`` bytes
that has a space at most at its ends. Hashes are differences of a running polynomial sum
modulo 2**64, so all runs of one length come from one subtraction. Long texts are handled in
slices that end between words, which gives the same n-grams.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_SLICE = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class HashedNgrams:
    """Bucket numbers of the words (if ``words``) and n-grams of texts."""

    def __init__(self, orders: tuple[int, ...], bits: int, words: bool):
        self.orders, self.bits, self.words = orders, bits, words
        self.size = 1 << bits
        self._up = self._down = np.zeros(0, np.uint64)

    def _ready(self, n: int) -> None:
        if len(self._up) < n:
            self._up = _powers(_BASE, n)
            self._down = _powers(pow(_BASE, -1, 1 << 64), n)

    def _buckets(self, hashes: np.ndarray, salt: int) -> np.ndarray:
        mixed = (hashes + np.uint64(salt)) * _MIX
        mixed ^= mixed >> np.uint64(32)
        return ((mixed * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def of_words(self, words: Iterable[bytes]) -> Iterator[tuple[np.ndarray, int]]:
        """For slices of the text: the buckets of all features, and how many words repeat the
        one before them."""
        held: list[bytes] = []
        size, last = 0, None
        for word in words:
            held.append(word)
            size += len(word) + 1
            if size > _SLICE:
                yield self._slice(held, last)
                held, size, last = [], 0, word
        if held:
            yield self._slice(held, last)

    def _slice(self, words: list[bytes], last: bytes | None) -> tuple[np.ndarray, int]:
        data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
        n = len(data)
        self._ready(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[:n], out=total[1:])
        space = data == 32
        spaces = np.zeros(n + 1, np.int32)
        np.cumsum(space, out=spaces[1:])
        found = []
        for k in self.orders:
            if n < k:
                continue
            hashes = (total[k:] - total[: n - k + 1]) * self._down[: n - k + 1]
            if k > 2:
                hashes = hashes[spaces[k - 1 : n] == spaces[1 : n - k + 2]]
            found.append(self._buckets(hashes, k))
        at = np.flatnonzero(space)
        whole = (total[at[1:]] - total[at[:-1] + 1]) * self._down[at[:-1] + 1]
        if self.words:
            found.append(self._buckets(whole, 0))
        repeats = int(np.count_nonzero(whole[1:] == whole[:-1])) + (last == words[0])
        return np.concatenate(found), repeats
