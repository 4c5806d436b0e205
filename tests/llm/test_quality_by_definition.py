"""The compression classifier against a plain version of it."""

import math
import random
import zlib

import numpy as np
import zstandard
from pyspark.sql import functions as F

from sitelens.llm import quality


def _texts(seed, n, junk):
    g = random.Random(seed)
    vocabulary = [f"{'zq' if junk else 'wo'}{g.randrange(400)}" for _ in range(300)]
    return [" ".join(g.choice(vocabulary) for _ in range(g.randrange(5, 400))) * (3 if junk and i % 5 == 0 else 1) for i in range(n)]


def _features(data, dictionaries):
    """(difference per byte, mean per byte) of the sizes of 2,048-byte blocks."""
    if not data:
        return 0.0, 0.0
    sizes = []
    for d in dictionaries:
        c = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False, write_dict_id=False,
                                     dict_data=zstandard.ZstdCompressionDict(d))
        sizes.append(sum(len(c.compress(data[i:i + 2048])) for i in range(0, len(data), 2048)))
    return (sizes[1] - sizes[0]) / len(data), sum(sizes) / 2 / len(data)


def _row(f):
    d, m = max(-.5, min(.5, f[0])), max(0.0, min(1.5, f[1]))
    return [1.0, 20 * d, 5 * m, 5 * m * m]


def _curve(rows, labels, weights):
    """Weighted ridge logistic curve by plain gradient steps with line search."""
    x, beta = np.array(rows), np.zeros(4)

    def loss(b):
        z = x @ b
        return float(np.sum(weights * (np.logaddexp(0, z) - labels * z)) + 0.005 * b @ b)

    for _ in range(400):
        p = 1 / (1 + np.exp(-(x @ beta)))
        grad = x.T @ (weights * (p - labels)) + 0.01 * beta
        hess = (x * (weights * np.maximum(p * (1 - p), 1e-12))[:, None]).T @ x + 0.01 * np.eye(4)
        step, t = np.linalg.lstsq(hess, grad, rcond=None)[0], 1.0
        while loss(beta - t * step) > loss(beta) and t > 1e-8:
            t /= 2
        beta = beta - t * step
        if np.abs(grad).max() < 1e-10:
            break
    return beta


def test_scores_by_definition(spark):
    texts = {i: t for i, t in enumerate(_texts(1, 90, False) + _texts(2, 70, True))}
    texts |= {500: "", 501: None, 502: texts[3], 503: texts[100], 504: "é" * 5000}
    marks = {i: int(i < 90) for i in range(160)} | {500: 1, 501: 0, 502: 1, 503: 0}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame(list(marks.items()), "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.score_documents(docs, quality.train(docs, labels)).collect()}

    held = {i for i in texts if zlib.crc32(str(i).encode()) % 4 == 2}
    order = {r["id"]: r["h"] for r in spark.createDataFrame([(i,) for i in texts], "id long").select("id", F.xxhash64("id").alias("h")).collect()}
    known = [i for i in marks if i not in held]
    classes = {}
    for q in (1, 0):
        found = [texts[i].encode() for i in sorted(known, key=order.get) if marks[i] == q and texts[i]]
        classes[q] = [t for k, t in enumerate(found) if t not in found[:k]]
    dictionaries = [zstandard.train_dictionary(64 << 10, [t[i:i + 2048] for t in classes[q][::2] for i in range(0, len(t), 2048)]).as_bytes() for q in (1, 0)]
    rest = [(t, q) for q in (1, 0) for t in classes[q][1::2]]
    y = np.array([q for _, q in rest], float)
    prior = sum(marks[i] for i in known) / len(known)
    w = np.array([prior / y.sum() if q else (1 - prior) / (len(y) - y.sum()) for _, q in rest]) * len(y)
    beta = _curve([_row(_features(t, dictionaries)) for t, _ in rest], y, w)
    for i, t in texts.items():
        want = prior if not t else 1 / (1 + math.exp(-float(np.dot(_row(_features(t.encode(), dictionaries)), beta))))
        assert abs(got[i]["score"] - want) < 1e-5, (i, got[i]["score"], want)
        assert got[i]["held_out"] == (i in held) and got[i]["predicted"] == int(got[i]["score"] >= 0.7)
    right = [got[i]["predicted"] == marks[i] for i in held if i in marks and texts[i]]
    assert sum(right) >= 0.95 * len(right) and len(right) > 25
