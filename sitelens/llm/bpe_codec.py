"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

A rolling hash cuts every text at places that depend only on the bytes just
before them, so passages that documents share fall into the same chunks. A
chunk is encoded once and its tokens are kept for the next document that
holds it (a bounded store per Python worker, kept from task to task).

Tokens near a cut can be wrong, since the tokenizer would have read on. A
blank after a non-blank character always starts a new pre-token, whatever
stands around it; between the first and the last such place ("anchors") the
tokens of a chunk equal those of the whole text. The rest of a chunk joins
that of its neighbours and is encoded anew. A chunk is used only if its token
edges agree exactly with its anchors; otherwise it is re-encoded as part of
a wider join, up to the whole text.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import binary_list, prepare

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
# The pre-tokenizer's pattern (fixed value of this tokenizer family).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Below this code point all Unicode versions agree on letters and numbers.
PLAIN = chr(0x250)
WINDOW = 32          # bytes that decide about a cut
MASK_BITS = 10       # mean chunk: 2 ** 10 bytes
_ANCHOR = re.compile(rb"(?<=[^\x09-\x0d\x1c-\x20\x80-\xff])[\x20\n]")
_GEAR = np.random.default_rng(20_260).integers(0, 2 ** 64, 256, dtype=np.uint64)


def cuts(data: bytes) -> list[int]:
    """Content-defined cut positions inside ``data``, on character edges."""
    n = len(data)
    if n <= 2 << MASK_BITS:
        return []
    b = np.frombuffer(data, np.uint8)
    g = _GEAR[b]
    # sum of the last WINDOW values, each shifted by its age: doubling steps
    h, span = g, 1
    while span < WINDOW:
        nxt = h.copy()
        nxt[span:] += h[:-span] << np.uint64(span)
        h, span = nxt, span * 2
    hit = np.flatnonzero((h >> np.uint64(64 - MASK_BITS)) == 0) + 1
    hit = hit[(hit >= WINDOW) & (hit < n)]
    return [int(i) for i in hit if data[i] & 0xC0 != 0x80]


class Codec:
    """Encoder and decoder for one Python worker.

    ``store_bytes`` bounds the kept chunks; a full store starts anew."""

    def __init__(self, path: str, store_bytes: int = 48 << 20):
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in piece): i for piece, i in spec["model"]["vocab"].items()
                 if all(c in letters for c in piece)}
        self.fast = tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.lengths = np.zeros(max([*ranks.values(), *self.special.values()]) + 1, np.int64)
        for piece, i in ranks.items():
            self.lengths[i] = len(piece)
        self.store: dict[bytes, tuple | None] = {}
        self.stored, self.store_bytes = 0, store_bytes
        self.chunks = self.reused = 0

    def plain(self, text: str) -> list[int]:
        """Tokens of text without special strings, by the library."""
        if not text:
            return []
        if max(text) < PLAIN:
            return self.fast.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def chunk(self, data: bytes) -> tuple | None:
        """(head, ids between the outer anchors, tail) of a chunk, or None if
        it has no two anchors or its token edges don't agree with them."""
        self.chunks += 1
        if data in self.store:
            self.reused += 1
            return self.store[data]
        anchors = [m.start() for m in _ANCHOR.finditer(data)]
        out = None
        if len(anchors) >= 2:
            p, q = anchors[0], anchors[-1]
            ids = np.array(self.plain(data.decode("utf-8")), np.uint32)
            edges = np.concatenate(([0], np.cumsum(self.lengths[ids])))
            i, j = np.searchsorted(edges, (p, q))
            if edges[-1] == len(data) and edges[i] == p and edges[j] == q:
                out = (data[:p], ids[i:j], data[q:])
        cost = 2 * len(data) + 400
        if self.stored + cost > self.store_bytes:
            self.store.clear()
            self.stored = 0
        self.store[data] = out
        self.stored += cost
        return out

    def segment(self, data: bytes) -> list[np.ndarray]:
        """Tokens of bytes without special strings, chunk by chunk."""
        at = cuts(data)
        if not at:
            return [np.array(self.plain(data.decode("utf-8")), np.uint32)]
        out, join = [], b""
        for lo, hi in zip([0, *at], [*at, len(data)]):
            piece = data[lo:hi]
            known = self.chunk(piece)
            if known is None:
                join += piece
                continue
            head, ids, tail = known
            out.append(np.array(self.plain((join + head).decode("utf-8")), np.uint32))
            out.append(ids)
            join = tail
        out.append(np.array(self.plain(join.decode("utf-8")), np.uint32))
        return out

    def encode(self, data: bytes) -> np.ndarray:
        """Token ids of a whole text given as UTF-8."""
        if not data:
            return np.zeros(0, np.uint32)
        if self.split is None or not any(s.encode() in data for s in self.special):
            return np.concatenate(self.segment(data))
        out: list[np.ndarray] = []
        for part in self.split.split(data.decode("utf-8")):
            if part in self.special:
                out.append(np.array([self.special[part]], np.uint32))
            elif part:
                out += self.segment(part.encode())
        return np.concatenate(out)

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


def _byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others take the code points from 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=2)
def worker_codec(path: str) -> Codec:
    """The codec of this Python worker: Spark reuses workers, so the loaded
    vocabulary and the store of chunks serve task after task."""
    return Codec(path)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text; null counts as empty (no tokens).

    One row per input row: doc_id (null stays null), n_tokens, ids_sha256 (ids
    as little-endian unsigned 32-bit integers), decoded_sha256, and with
    ``with_ids`` also ids (array of int) and decoded. Other columns are not
    read. No shuffle: memory holds one batch of texts and the bounded store."""
    prepare(docs.sparkSession)
    path = path or default_path()
    schema = SCHEMA + (", ids array<int>, decoded string" if with_ids else "")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(path)
        for batch in batches:
            ids = [codec.encode(b) for b in binary_list(batch.column(1))]
            texts = []
            for lo in range(0, len(ids), 64):
                texts += codec.decode([x.tolist() for x in ids[lo:lo + 64]])
            out = [batch.column(0), pa.array([len(x) for x in ids], pa.int64()),
                   pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                   pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts])]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                out += [pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(texts, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(out, names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
