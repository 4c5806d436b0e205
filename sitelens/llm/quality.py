"""Compression classifier for text quality.

Two zstandard dictionaries are built from labelled good and bad texts. A text
is compressed in blocks with either; the size difference per byte says which
class it resembles, and a logistic curve fitted on other labelled texts turns
it into a probability. The mean compressed size per byte enters the curve as
well: endless repetition compresses alike with both dictionaries.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import binary_list, map_arrow, prepare

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
THRESHOLD = 0.7
BLOCK = 2048             # bytes compressed at a time, so long texts keep seeing the dictionary
LEVEL = 3
DICT_BYTES = 64 << 10


def held_out(id_col) -> F.Column:
    """Rows that no model may learn from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


class _Sizes:
    """Compressed sizes under both dictionaries (one per Python worker)."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard
        self.pair = [zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False,
                                              write_dict_id=False, dict_data=zstandard.ZstdCompressionDict(d))
                     for d in (good, bad)]

    def features(self, data: bytes) -> tuple[float, float]:
        """(size difference per byte, mean size per byte); zeros if empty."""
        n = len(data)
        if not n:
            return 0.0, 0.0
        view = memoryview(data)
        a, b = (sum(len(c.compress(view[i:i + BLOCK])) for i in range(0, n, BLOCK)) for c in self.pair)
        return (b - a) / n, (a + b) / (2 * n)


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    prior: float

    def score(self, features: np.ndarray, empty: np.ndarray) -> np.ndarray:
        """Probability of label 1; an empty text gets the share of label 1."""
        p = 1 / (1 + np.exp(-np.clip(_design(features) @ np.array(self.weights), -40, 40)))
        return np.where(empty, self.prior, p)


def _design(f: np.ndarray) -> np.ndarray:
    d, m = f[:, 0], f[:, 1]
    return np.stack([np.ones(len(f)), 20 * np.clip(d, -.5, .5), 5 * np.clip(m, 0, 1.5), 5 * np.clip(m, 0, 1.5) ** 2], axis=1)


def _fit_logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        grad = x.T @ (w * (y - p)) - ridge * beta
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta)), grad)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = 3000, sample_bytes: int = 24 << 20) -> QualityModel | None:
    """Fit on a bounded sample: of either class the ``rows_per_class`` labelled
    documents that come first by a hash of the id (one half for the
    dictionary, one for the curve), dropping the longest while a class has
    more than ``sample_bytes``; equal texts count once, and of an id with several
    texts its shortest. Held-out rows and rows with a null id, label or text are
    never read, and at most ``rows_per_class`` texts a class come to the driver. A document with several labels counts with the
    larger one. None if a class has fewer than 8 documents."""
    spark = docs.sparkSession
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    shares = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [r for q in (0, 1) for r in known.filter(F.col("quality") == q)
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class).collect()]
    ids = spark.createDataFrame([(r["doc_id"], r["quality"]) for r in picked], "_id long, _quality int")
    texts = (docs.filter(F.col("text") != "").join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
             .groupBy("_id", "_quality").agg(F.min(F.struct(F.octet_length("text").alias("n"), F.xxhash64("text").alias("h"))).alias("t")))
    keep = []
    for q in (0, 1):
        total = 0
        for r in sorted((r for r in texts.collect() if r["_quality"] == q), key=lambda r: (r["t"]["n"], r["_id"])) if picked else []:
            total += r["t"]["n"]
            if total <= sample_bytes:
                keep.append((r["_id"], q, r["t"]["n"], r["t"]["h"]))
    ids = spark.createDataFrame(keep, "_id long, _quality int, _n int, _h long")
    sample = {0: [], 1: []}
    if keep:
        chosen = docs.join(F.broadcast(ids), (F.col("doc_id") == F.col("_id")) & (F.octet_length("text") == F.col("_n")) & (F.xxhash64("text") == F.col("_h")))
        # one row per id, however often it stands in the table
        for r in chosen.groupBy("_id", "_quality").agg(F.max("text").alias("text")).select("_quality", F.xxhash64("_id").alias("_h"), "text").collect():
            sample[r["_quality"]].append((r["_h"], r["text"].encode("utf-8")))
    # copies of a text count once: a large group of them would be all that the dictionary learns
    good, bad = (list(dict.fromkeys(t for _, t in sorted(sample[q]))) for q in (1, 0))
    if min(len(good), len(bad)) < 8:
        return None
    dicts = [_dictionary(x[::2]) for x in (good, bad)]
    sizes = _Sizes(*dicts)
    rest = [(t, 1) for t in good[1::2]] + [(t, 0) for t in bad[1::2]]
    y = np.array([q for _, q in rest], float)
    x = _design(np.array([sizes.features(t) for t, _ in rest]))
    prior = shares[1] / (shares[0] + shares[1])
    w = np.where(y == 1, prior / max(1, y.sum()), (1 - prior) / max(1, (1 - y).sum())) * len(y)
    return QualityModel(*dicts, tuple(float(b) for b in _fit_logistic(x, y, w)), prior)


def _dictionary(texts: list[bytes]) -> bytes:
    """A zstandard dictionary; raw text where there is too little to train."""
    import zstandard
    blocks = [t[i:i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[:DICT_BYTES] or b" "


def score_documents(docs: DataFrame, model: QualityModel | None, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= threshold) per row.

    Whole texts; null and empty texts get the model's prior. Without a model
    (too few labels) every score is 1. A null id is not held out. Other
    columns are not read."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = _Sizes(model.good, model.bad) if model else None
        for batch in batches:
            texts = binary_list(batch.column(2))
            if model:
                f = np.array([sizes.features(t) for t in texts]).reshape(-1, 2)
                s = model.score(f, np.array([not t for t in texts], bool))
            else:
                s = np.ones(len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s, pa.float64()),
                 pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, model: QualityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of the rows that the model doesn't reject; without a model
    every row stays. The rows pass through Python once and aren't shuffled."""
    if model is None:
        return docs
    prepare(docs.sparkSession)
    names = docs.columns
    at = names.index("text")
    box: list[_Sizes] = []

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not box:
            box.append(_Sizes(model.good, model.bad))
        texts = binary_list(batch.column(at))
        f = np.array([box[0].features(t) for t in texts]).reshape(-1, 2)
        return batch.filter(pa.array(model.score(f, np.array([not t for t in texts], bool)) >= threshold))

    # positions as names: the columns may clash
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return map_arrow(flat, keep, flat.schema).toDF(*names)
