"""Hashes of a text's words, made for all words at once.

A word is a run of letters and digits of the lower-cased text.  Its hash is a
polynomial in its UTF-8 bytes, read off prefix sums modulo 2**64, so the cost
is a few passes over the bytes however many words there are.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_powers = np.ones(1, dtype=np.uint64)
_unpowers = np.ones(1, dtype=np.uint64)


def _grown(powers: np.ndarray, base: int, size: int) -> np.ndarray:
    while len(powers) < size:
        step = np.uint64(pow(base, len(powers), 1 << 64))
        powers = np.concatenate([powers, powers * step])
    return powers


def mixed(h: np.ndarray) -> np.ndarray:
    """A finalizer: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Words:
    """starts, ends: byte places of the words of raw, the lower-cased text."""

    def __init__(self, text: str):
        global _powers, _unpowers
        self.raw = np.frombuffer(text.lower().encode(), dtype=np.uint8)
        n = len(self.raw)
        edges = np.flatnonzero(np.diff(_IS_WORD[self.raw], prepend=False, append=False))
        self.starts, self.ends = edges[::2], edges[1::2]
        if len(_powers) <= n:
            _powers = _grown(_powers, _BASE, n + 1)
            _unpowers = _grown(_unpowers, _UNBASE, n + 1)
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.raw * _powers[:n], out=self._sums[1:])

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, most_bytes: int | None = None) -> np.ndarray:
        """One per word; with most_bytes, of its first bytes only."""
        ends = self.ends
        if most_bytes:
            ends = np.minimum(ends, self.starts + most_bytes)
        return mixed((self._sums[ends] - self._sums[self.starts]) * _unpowers[self.starts])


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words; a shorter text is one shingle."""
    if not len(words):
        return words
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k in range(size):
        out = out * np.uint64(_BASE) + words[k : len(words) - size + 1 + k]
    return mixed(out + np.uint64(size))
