"""Words of many texts at once: positions, exact numbers and digests (NumPy).

Texts are UTF-8 bytes joined by a line feed, which no caller counts as part of
a word. Words and grams of one call get numbers that are exact, not hashes:
words are compared byte for byte (beyond 16 bytes by 128-bit digests), grams
by the numbers of their parts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from sitelens.llm.shingles import mix

# Bytes of text that a task looks at in one go; a longer text is looked at whole.
BATCH_BYTES = 4 << 20
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def byte_set(*members: int) -> np.ndarray:
    """A table over the 256 byte values, true at ``members``."""
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


def gather(batches: Iterable[pa.RecordBatch], column: int, limit: int = BATCH_BYTES) -> Iterator[pa.Table]:
    """Consecutive rows as tables with about ``limit`` bytes in ``column``."""
    held, size = [], 0
    for batch in batches:
        at = 0
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        for cut in np.flatnonzero(np.diff((size + np.cumsum(lengths)) // limit)) + 1:
            held.append(batch.slice(at, cut - at))
            yield pa.Table.from_batches(held)
            held, at = [], int(cut)
        held.append(batch.slice(at))
        size = int(lengths[at:].sum()) + (size if at == 0 else 0)
        if size >= limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


class Tokens:
    """The words of ``texts``: ``lo`` and ``hi`` (byte positions in ``data``) and
    ``row`` (the text)."""

    def __init__(self, texts: list[bytes], in_word: np.ndarray, lower: bool):
        data = b"\n".join(texts)
        self.data = data.translate(LOWER) if lower else data
        self.bytes = np.frombuffer(self.data, np.uint8)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], in_word[self.bytes], [False])).view(np.int8)))
        self.lo, self.hi = edge[::2], edge[1::2]
        starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]) if texts else np.zeros(0, np.int64)
        self.row = np.searchsorted(starts, self.lo, "right") - 1
        self.n = len(self.lo)

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(a, b, length): equal for equal words; the bytes themselves up to 16."""
        n = self.hi - self.lo
        padded = b"\0" * 8 + self.data + b"\0" * 8
        view = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
        short = np.minimum(n, 8)
        a = view[self.lo + 8] & _MASK[short]
        b = view[self.hi] >> (np.uint64(8) * (8 - short).astype(np.uint64))
        for i in np.flatnonzero(n > 16):
            d = xxhash.xxh3_128_intdigest(self.data[self.lo[i]:self.hi[i]])
            a[i], b[i] = d >> 64, d & (2 ** 64 - 1)
        return a, b, n.astype(np.uint64)

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit digests of every word."""
        a, b, n = self.keys()
        return mix(a + _K1 * mix(b + _K2 * n)), mix(b + _K3 * mix(a + _K1 * n))


class Words(Tokens):
    """Tokens with ``ids`` (numbers of equal words) and ``of`` (a token of every
    number). ``kind`` (a small number per text) keeps equal words of different
    kinds apart."""

    def __init__(self, texts: list[bytes], in_word: np.ndarray, lower: bool, kind: np.ndarray | None = None):
        super().__init__(texts, in_word, lower)
        self._number(kind)

    def _number(self, kind: np.ndarray | None) -> None:
        a, b, n = self.keys()
        k = kind[self.row].astype(np.uint64) if kind is not None else np.zeros(self.n, np.uint64)
        plain = mix(a + _K1 * mix(b + _K2 * n))
        salt = np.uint64(0)
        while True:
            _, of, ids = np.unique(mix(plain + _K3 * k + salt), return_index=True, return_inverse=True)
            rep = of[ids]
            if all((x == x[rep]).all() for x in (a, b, n, k)):
                break
            # two words met in one digest: number them anew
            salt += np.uint64(1)
            plain = mix(a ^ mix(b + _K2 * n + salt))
        self.ids, self.of = ids.astype(np.int64), of

    def texts(self) -> pa.Array:
        """Every number's word."""
        return pa.array([self.data[l:h] for l, h in zip(self.lo[self.of].tolist(), self.hi[self.of].tolist())], pa.binary()).cast(pa.string())


def number_pairs(left: np.ndarray, right: np.ndarray, n_right: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers, a place of every number, counts) of equal pairs."""
    _, of, ids, count = np.unique(left.astype(np.uint64) * np.uint64(max(1, n_right)) + right.astype(np.uint64),
                                  return_index=True, return_inverse=True, return_counts=True)
    return ids.astype(np.int64), of, count
