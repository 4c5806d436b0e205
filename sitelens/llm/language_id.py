"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds its
letters' vectors by products after rotating each by its place; a document's
vector bundles (adds) those of its n-grams, a language prototype bundles its
documents. The nearest prototype by cosine wins.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import prepare, text_list
from sitelens.llm.quality import held_out

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
UNKNOWN = "und"
DIM = 1024
GRAM = 3
SHARPNESS = 25.0     # of the softmax over cosines
BLOCK_DOCS = 48      # documents bundled in one product
_SPACE = 32


class Space:
    """Letter and n-gram vectors of one Python worker."""

    def __init__(self, dim: int = DIM, cache: int = 30_000):
        self.dim, self.cache = dim, cache
        self.letters: dict[int, np.ndarray] = {}
        self.grams: dict[int, np.ndarray] = {}
        codes = np.arange(0x110000, dtype=np.uint32)
        alpha = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        self.fold = np.where(alpha, codes, np.uint32(_SPACE))

    def letter(self, code: int) -> np.ndarray:
        v = self.letters.get(code)
        if v is None:
            v = np.random.default_rng([code, 17]).integers(0, 2, self.dim).astype(np.int8) * 2 - 1
            self.letters[code] = v
        return v

    def gram(self, key: int) -> np.ndarray:
        v = self.grams.get(key)
        if v is None:
            v = np.ones(self.dim, np.int8)
            for place in range(GRAM):
                code = (key >> (21 * (GRAM - 1 - place))) & 0x1FFFFF
                v = v * np.roll(self.letter(code), GRAM - 1 - place)
            if len(self.grams) >= self.cache:
                self.grams.clear()
            self.grams[key] = v
        return v

    def keys(self, text: str) -> np.ndarray:
        """n-grams of the lower-cased letters, runs of other characters being
        one blank; the text stands between blanks. Empty without a letter."""
        x = self.fold[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
        x = np.concatenate(([_SPACE], x, [_SPACE])).astype(np.int64)
        x = x[np.concatenate(([True], (x[1:] != _SPACE) | (x[:-1] != _SPACE)))]
        if len(x) < GRAM:
            return np.zeros(0, np.int64)
        return (x[:-2] << 42) | (x[1:-1] << 21) | x[2:]

    def bundle(self, texts: list[str]) -> np.ndarray:
        """Unit document vectors, a row per text; zeros without a letter."""
        out = np.zeros((len(texts), self.dim), np.float32)
        for lo in range(0, len(texts), BLOCK_DOCS):
            counted = [np.unique(self.keys(t), return_counts=True) for t in texts[lo:lo + BLOCK_DOCS]]
            seen = np.unique(np.concatenate([k for k, _ in counted]))
            for at in range(0, len(seen), 20_000):
                part = seen[at:at + 20_000]
                vectors = np.stack([self.gram(int(k)) for k in part]).astype(np.float32)
                counts = np.zeros((len(counted), len(part)), np.float32)
                for i, (k, c) in enumerate(counted):
                    j = np.searchsorted(part, k)
                    ok = j < len(part)
                    ok[ok] = part[j[ok]] == k[ok]
                    counts[i, j[ok]] = c[ok]
                out[lo:lo + len(counted)] += counts @ vectors
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm == 0, 1, norm)


@functools.lru_cache(maxsize=2)
def worker_space(dim: int) -> Space:
    """The vectors of this Python worker; Spark reuses workers."""
    return Space(dim)


def train(docs: DataFrame, dim: int = DIM) -> dict[str, list[float]]:
    """Prototype per language, from every document that isn't held out and
    has a language: each task bundles what it reads to one vector per
    language, and Spark adds these. The driver gets one vector per language."""
    prepare(docs.sparkSession)
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id")).select("lang", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = worker_space(dim), {}
        for batch in batches:
            vectors = space.bundle(text_list(batch.column(1)))
            for lang, v in zip(batch.column(0).to_pylist(), vectors):
                if lang not in sums:
                    sums[lang] = np.zeros(dim)
                sums[lang] += v
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array(list(sums.values()), pa.list_(pa.float64()))],
                                             ["lang", "v"])

    parts = rows.mapInArrow(run, "lang string, v array<double>")
    totals = parts.select("lang", F.posexplode("v").alias("d", "x")).groupBy("lang", "d").agg(F.sum("x").alias("x"))
    vectors = totals.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("d", "x"))).alias("v")).collect()
    return {r["lang"]: [e["x"] for e in r["v"]] for r in sorted(vectors, key=lambda r: r["lang"]) if any(e["x"] for e in r["v"])}


def predict(docs: DataFrame, prototypes: dict[str, list[float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score per input row; whole texts.

    A null text or one without letters gives ``und`` and score 0, as does
    every row if nothing was learned. Equal cosines go to the first language
    in alphabetical order. A null id is not held out. Only the text decides."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    langs = sorted(prototypes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = worker_space(len(prototypes[langs[0]]) if langs else DIM)
        proto = np.array([prototypes[x] for x in langs], np.float32).reshape(len(langs), space.dim)
        proto = proto / np.maximum(np.linalg.norm(proto, axis=1, keepdims=True), 1e-9)
        for batch in batches:
            vectors = space.bundle(text_list(batch.column(2)))
            known = np.abs(vectors).sum(axis=1) > 0
            names, scores = [UNKNOWN] * len(vectors), np.zeros(len(vectors))
            if langs:
                cos = vectors @ proto.T
                best = cos.argmax(axis=1)
                soft = np.exp(SHARPNESS * (cos - cos.max(axis=1, keepdims=True)))
                scores = np.where(known, 1 / soft.sum(axis=1), 0.0)
                names = [langs[b] if k else UNKNOWN for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()),
                                              pa.array(scores.astype(float), pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, SCHEMA)
