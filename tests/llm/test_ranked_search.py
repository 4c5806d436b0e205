import math
import re
from collections import Counter

import numpy as np
import pytest
from conftest_llm import CLASHES

from sitelens.llm import ranked_search as R


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, top=20):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for t, c in df.items()}
    out = []
    for item, text in items:
        q = Counter(terms(text))
        found = []
        for d, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // n_terms
            s = sum(k * w[t] * ((10 ** 9 * b[t]) // (1000 * b[t] + 12 * m)) for t, k in q.items() if t in b)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(found)[:top])]
    return sorted(out, key=lambda r: [(x is None, x or 0) for x in r])


def tables(spark, docs, items, extra=""):
    more = [f"'x' AS {c}" for c in extra.split()]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).selectExpr("*", *more)
    return d, spark.createDataFrame(items, "item_id long, text string").selectExpr("*", *more)


def got(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=lambda r: [(x is None, x or 0) for x in r])


def corpus(n, seed, vocabulary=300):
    g = np.random.default_rng(seed)
    pick = lambda k: " ".join(f"t{min(int(g.zipf(1.3)), vocabulary)}" for _ in range(k))
    docs = [(i, pick(g.integers(0, 80))) for i in range(n)]
    items = [(i, pick(g.integers(1, 25)) + " " + " ".join(docs[i * 7 % n][1].split()[:10])) for i in range(12)]
    return docs, items


@pytest.mark.parametrize("top", [20, 3])
def test_against_brute_force(spark, top):
    docs, items = corpus(700, 1)
    docs += [(None, docs[3][1]), (10 ** 12, docs[3][1]), (3, docs[3][1])] + [(5000 + i, docs[9][1]) for i in range(60)]
    docs += [(8000, None), (8001, ""), (8002, " --- "), (8003, "Ünlü 中文 T1 t1 T2"), (8004, "x" * 50_000)]
    items += [(100, None), (101, ""), (102, "nowhere"), (103, "Ünlü t1 t1 t1"), (None, "t5 t6 t7"), (0, "t2 t9 t4"), (0, "t2 t9 t4")]
    d, i = tables(spark, docs, items, CLASHES + " q terms rank score")
    assert got(R.search(d, i, top)) == brute(docs, items, top)


def test_small_chunks_batches_of_queries_and_seeds(spark, monkeypatch):
    docs, items = corpus(400, 2)
    for name, value in (("CHUNK", 32), ("BLOCK", 3), ("BATCH_TERMS", 60), ("SEED_ROWS", 5)):
        monkeypatch.setattr(R, name, value)
    assert got(R.search(*tables(spark, docs, items))) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = corpus(5, 3)
    d, i = tables(spark, docs, items)
    assert R.search(d.limit(0), i).count() == 0 and R.search(d, i.limit(0)).count() == 0
    assert R.search(d.selectExpr("doc_id", "'-' AS text"), i).count() == 0


def _chunk_of(docs, queries, n_docs, n_terms):
    known = queries.words
    bags = [Counter(known[t.encode()] for t in terms(x) if t.encode() in known) for _, x in docs]
    lens = np.array([len(terms(x)) for _, x in docs])
    import pyarrow as pa
    order = [sorted(b) for b in bags]
    t = np.array([k for o in order for k in o], np.int64)
    tf = np.array([b[k] for o, b in zip(order, bags) for k in o], np.int64)
    sizes = np.array([len(o) for o in order])
    m = R._length_norm(lens, n_docs, n_terms)
    return R._Chunk(pa.array([d for d, _ in docs], pa.int64()), sizes, t, R.impact(tf, np.repeat(m, sizes)))


def test_summaries_bound_their_blocks_and_blocks_are_skipped():
    docs, items = corpus(600, 4)
    docs = [d for d in docs if terms(d[1])]
    rows = [{"item_id": i, "terms": sorted(Counter(terms(t))), "times": [c for _, c in sorted(Counter(terms(t)).items())]} for i, t in items]
    q = R._number_terms(rows)
    n_terms = sum(len(terms(t)) for _, t in docs)
    df = Counter(t for _, x in docs for t in set(terms(x)))
    q.weight = np.array([math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[w.decode()] + 1))) for w in q.words], np.int64)
    c = _chunk_of(docs, q, len(docs), n_terms)
    full = np.array([c.scores(q, k, np.arange(len(docs))) for k in range(len(items))])
    q.floor = np.sort(full, axis=1)[:, -20]
    largest = np.zeros(len(q.words), np.int64)
    np.maximum.at(largest, c.terms, c.impacts)
    q.needed = R._needed(q, largest)
    # a document that reaches a floor has a term of a list that is searched
    for k in range(len(items)):
        needed = set(q.needed[k].tolist())
        for r in np.flatnonzero(full[k] >= q.floor[k]):
            ends = np.concatenate(([0], c.ends))
            assert needed & set(c.terms[ends[r]:ends[r + 1]].tolist())
    blocker = R._Blocker(q)
    batch = blocker.build(c)
    row = {n: batch.column(n)[0].values for n in batch.schema.names}
    row = {n: v if n == "doc_ids" else v.to_numpy(zero_copy_only=False) for n, v in row.items()}
    block, first = 0, 0
    for i, term in enumerate(row["lists"].tolist()):
        listed = []
        while block < row["list_ends"][i]:
            members = row["members"][(row["member_ends"][block - 1] if block else 0):row["member_ends"][block]]
            lo, hi = (row["coord_ends"][block - 1] if block else 0), row["coord_ends"][block]
            top = dict(zip(row["coords"][lo:hi].tolist(), row["maxima"][lo:hi].tolist()))
            for k in blocker.lists[term]:
                bound = sum(int(x) * top.get(t, 0) for t, x in zip(q.terms[k].tolist(), q.weights(k).tolist()))
                assert bound >= full[k][members].max()
            listed += members.tolist()
            block += 1
        assert sorted(listed) == sorted(c.postings(c.column(term)).tolist())
    qs, ids, scores, met, scored = blocker.search(row, 20)
    assert scored < met
    for k in range(len(items)):
        want = sorted(full[k], reverse=True)[:20]
        assert sorted(scores[qs == k].tolist(), reverse=True) == [int(s) for s in want]
