"""Word shingles of whole texts as 64-bit digests, vectorised over bytes.

A word is a run of bytes other than 0x20 and 0x09-0x0D, after A-Z are
lower-cased; in UTF-8 these bytes are never part of another character. A
shingle is ``width`` words in a row; a text with fewer words has one shingle,
its whole word sequence; a text without words has none.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
# odd multipliers of the polynomial hashes
_BYTE = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.uint64(0xC2B2AE3D27D4EB4F)
_SALT = np.random.default_rng(5_150).integers(1, 2 ** 63, 256, dtype=np.uint64)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def inverse(base: np.uint64) -> np.uint64:
    """The inverse of an odd number modulo 2 ** 64."""
    return np.uint64(pow(int(base), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the word (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Hasher:
    """Power tables that grow with the longest text seen by a worker."""

    def __init__(self) -> None:
        self.size = 0

    def _tables(self, n: int) -> None:
        if n > self.size:
            self.size = max(2 * n, 1 << 16)
            self.up = powers(_BYTE, self.size)
            self.down = powers(inverse(_BYTE), self.size)

    def words(self, data: bytes) -> np.ndarray:
        """A digest per word, in order."""
        b = np.frombuffer(data.translate(_LOWER), np.uint8)
        if not len(b):
            return np.zeros(0, np.uint64)
        self._tables(len(b) + 1)
        word = ~_BLANK[b]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
        lo, hi = edge[::2], edge[1::2]
        total = np.concatenate(([np.uint64(0)], np.cumsum(_SALT[b] * self.up[:len(b)], dtype=np.uint64)))
        return mix((total[hi] - total[lo]) * self.down[lo] + (hi - lo).astype(np.uint64))

    def shingles(self, data: bytes, width: int = WIDTH) -> np.ndarray:
        """The sorted distinct shingle digests of a text given as UTF-8."""
        w = self.words(data)
        if not len(w):
            return w
        n = max(1, len(w) - width + 1)
        h = np.zeros(n, np.uint64)
        for i in range(min(width, len(w))):
            h = mix(h * _WORD + w[i:i + n])
        # shorter sequences can't equal longer ones
        return np.unique(h if len(w) >= width else mix(h + np.uint64(len(w))))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
