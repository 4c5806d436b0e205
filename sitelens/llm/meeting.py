"""Which hash values of a document also lie in another one.

Tasks send their documents' hashes by radix digit, packed and sorted; a
digit's task sorts what it gets and answers the documents whose values it met
in two documents. A value that a task meets twice by itself is answered there
and sent for two documents only, so a digit gets few rows of a value that all
documents have: its load follows the number of tasks, not of documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sitelens.llm.common import binary_list

HASH_BITS = 48           # of a value that are compared: a false match is possible, a missed one isn't
CHUNK = 500_000          # values that a task packs together
_SENT = ["digit", "known", "hashes", "nodes"]
_ASK = "digit int, known boolean, hashes array<binary>, nodes array<binary>"


def _pack(values: np.ndarray) -> bytes:
    """Sorted 64-bit values as their differences, byte planes apart."""
    import zstandard
    step = np.diff(values, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(step.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    step = np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").ravel().astype(np.uint64)
    return np.cumsum(step, dtype=np.uint64)


def _pack_nodes(nodes: np.ndarray) -> bytes:
    """Documents, in any order, as distinct names and places among them."""
    import zstandard
    names, at = np.unique(nodes, return_inverse=True)
    width = 2 if len(names) <= 65536 else 4
    planes = at.astype(f"<u{width}").view(np.uint8).reshape(len(at), width).T
    raw = np.int64(len(names)).tobytes() + np.diff(names, prepend=0).tobytes() + planes.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack_nodes(data: bytes) -> np.ndarray:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    names = np.cumsum(np.frombuffer(raw, np.int64, n, 8))
    width = 2 if n <= 65536 else 4
    at = np.frombuffer(raw, np.uint8, offset=8 + 8 * n) if len(raw) > 8 + 8 * n else np.zeros(0, np.uint8)
    at = at.reshape(width, -1).T
    return names[np.ascontiguousarray(at).view(f"<u{width}").ravel()]


def _by_node(nodes: np.ndarray, h: np.ndarray, count: bool) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Blocks of (documents, their distinct hashes or the number of these)."""
    order = np.lexsort((h, nodes))
    nodes, h = nodes[order], h[order]
    cut = np.append(np.flatnonzero(np.concatenate(([True], nodes[1:] != nodes[:-1]))), len(nodes))
    for lo in range(0, len(cut) - 1, 2000):
        part = cut[lo:lo + 2001]
        yield nodes[part[:-1]], [np.int64(j - i).tobytes() if count else h[i:j].tobytes() for i, j in zip(part[:-1], part[1:])]


def _repeats(h: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For hashes in sorted order: where each distinct one begins, how many
    entries it has, and whether it lies in two documents."""
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    many = np.minimum.reduceat(nodes, first) != np.maximum.reduceat(nodes, first)
    return first, np.diff(np.append(first, len(h))), many


def _by_digit(h: np.ndarray, digits: int) -> np.ndarray:
    """Where the values of each radix digit begin, in sorted values."""
    edges = [-(-(d << HASH_BITS) // digits) for d in range(digits)]
    return np.append(np.searchsorted(h, np.array(edges, np.uint64)), len(h))


def _send(hs: list[np.ndarray], nodes: list[np.ndarray], digits: int, lot: int, count: bool) -> Iterator[pa.RecordBatch]:
    """What a task sends of a chunk of documents: per digit the values to ask
    for and those it has met twice, and per document the latter."""
    h, node = np.concatenate(hs), np.concatenate(nodes)
    order = np.lexsort((node, h))
    h, node = h[order], node[order]
    first, n, many = _repeats(h, node)
    twice = np.repeat(many, n)
    for names, lists in _by_node(node[twice], h[twice], count) if twice.any() else ():
        yield pa.RecordBatch.from_arrays([pa.array([lot % digits], pa.int32()), pa.array([True]),
                                          pa.array([lists], pa.list_(pa.binary())),
                                          pa.array([[names.astype("<i8").tobytes()]], pa.list_(pa.binary()))], _SENT)
    asked, ask = h[first][~many], node[first][~many]
    met = np.repeat(h[first][many], 2)
    ends = np.stack((node[first][many], node[first + n - 1][many]), axis=1).ravel()
    cut, two = _by_digit(asked, digits), _by_digit(met, digits)
    full = [d for d in range(digits) if cut[d] < cut[d + 1] or two[d] < two[d + 1]]
    yield pa.RecordBatch.from_arrays(
        [pa.array(full, pa.int32()), pa.array([False] * len(full)),
         pa.array([[_pack(asked[cut[d]:cut[d + 1]]), _pack(met[two[d]:two[d + 1]])] for d in full], pa.list_(pa.binary())),
         pa.array([[_pack_nodes(ask[cut[d]:cut[d + 1]]), _pack_nodes(ends[two[d]:two[d + 1]])] for d in full],
                  pa.list_(pa.binary()))], _SENT)


def shared_hashes(texts: DataFrame, hasher: Callable[[], Callable[[bytes], np.ndarray]], digits: int,
                  count: bool = False, parts: int | None = None) -> DataFrame:
    """(node, hashes): a document's values that another document has too, as
    64-bit integers, each in one row of the document; with ``count`` (node, n)
    with their numbers instead.

    A digit is settled at a time, so ``digits`` bound what a task holds; they lie
    in ``parts`` partitions (as many as digits).
    ``texts`` has node (one row each) and text; ``hasher`` makes a function
    from the text's bytes to its sorted distinct values of HASH_BITS bits."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, hs, nodes, held, lot = hasher(), [], [], 0, 0
        for batch in batches:
            for node, data in zip(batch.column(0).to_pylist(), binary_list(batch.column(1))):
                h = values(data)
                if not len(h):
                    continue
                lot = lot or node & 0x7FFFFFFF
                hs.append(h)
                nodes.append(np.full(len(h), node, np.int64))
                held += len(h)
                if held >= CHUNK:
                    yield from _send(hs, nodes, digits, lot, count)
                    hs, nodes, held, lot = [], [], 0, lot + 1
        if hs:
            yield from _send(hs, nodes, digits, lot, count)

    def answer(names: np.ndarray, lists: list[bytes]) -> pa.RecordBatch:
        found = pa.array(np.frombuffer(b"".join(lists), np.int64)) if count else pa.array(lists, pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), found], ["node", "n" if count else "hashes"])

    def settle(blocks: list[tuple]) -> Iterator[pa.RecordBatch]:
        parts = [(_unpack(h), _unpack_nodes(n), bool(i)) for hs, nodes in blocks for i, (h, n) in enumerate(zip(hs, nodes))]
        h, node = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
        told = np.concatenate([np.full(len(x[0]), x[2]) for x in parts])
        order = np.argsort(h, kind="stable")
        h, node, told = h[order], node[order], told[order]
        _, n, many = _repeats(h, node)
        keep = np.repeat(many, n) & ~told
        if keep.any():
            for names, lists in _by_node(node[keep], h[keep], count):
                yield answer(names, lists)

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digit, blocks = None, []
        for batch in batches:
            for d, known, hs, nodes in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if known:
                    yield answer(np.frombuffer(nodes[0], "<i8"), hs)
                    continue
                if d != digit and blocks:
                    yield from settle(blocks)
                    blocks = []
                digit = d
                blocks.append((hs, nodes))
        if blocks:
            yield from settle(blocks)

    sent = texts.select("node", "text").mapInArrow(send, _ASK)
    return (sent.repartition(parts or digits, "digit").sortWithinPartitions("digit")
            .mapInArrow(meet, "node long, n long" if count else "node long, hashes binary"))
