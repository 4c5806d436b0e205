"""Exact Ward against greedy Ward that looks at every pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitelens.operators import ward as W


def greedy(points, k):
    """(merges, labels) of weighted greedy Ward over distinct positions;
    ``points`` is {id: position}."""
    at = {}
    for i, p in points.items():
        at.setdefault(tuple(p), []).append(i)
    live = {min(ids): (float(len(ids)), np.array(p), list(ids)) for p, ids in at.items()}
    merges, labels = [], None
    while True:
        if len(live) <= k and labels is None:
            labels = {i: c for c, r in enumerate(sorted(live)) for i in live[r][2]}
        if len(live) < 2:
            return merges, labels
        ids = sorted(live)
        n = np.array([live[i][0] for i in ids])
        x = np.array([live[i][1] for i in ids])
        cost = n[:, None] * n[None, :] / (n[:, None] + n[None, :]) * ((x[:, None] - x[None]) ** 2).sum(-1)
        cost[np.tril_indices(len(ids))] = np.inf
        a, b = min(map(tuple, np.argwhere(cost == cost.min())), key=lambda p: (ids[p[0]] * ids[p[1]] % W.MIX * W.FACTOR % W.MIX, p))
        (na, xa, ma), (nb, xb, mb) = live[ids[a]], live.pop(ids[b])
        merges.append((ids[a], ids[b], float(cost[a, b])))
        live[ids[a]] = (na + nb, (na * xa + nb * xb) / (na + nb), ma + mb)


def _frame(spark, points, extra=()):
    d = len(next(iter(points.values())))
    rows = [(i, *map(float, p)) for i, p in points.items()] + list(extra)
    return spark.createDataFrame(rows, "pt_id long, " + ", ".join(f"f{i} double" for i in range(d))), [f"f{i}" for i in range(d)]


def _labels(df):
    return {r.pt_id: r.cluster for r in df.collect()}


@pytest.mark.parametrize("d,seed", [(1, 1), (3, 3)])
def test_tree_and_clusters_equal_greedy(spark, d, seed):
    """Dense blobs, a wide field and far outliers; only the last 20 clusters finish on the driver."""
    rnd = np.random.default_rng(seed)
    x = np.vstack([rnd.normal(c, s, size=(40, d)) for c, s in ((0, 0.1), (3, 0.5), (-4, 2))] + [rnd.uniform(-40, 40, (8, d))])
    points = {int(i): tuple(p) for i, p in zip(rnd.permutation(len(x)), x)}
    merges, labels = greedy(points, 5)
    df, cols = _frame(spark, points)
    reps = W.representatives(df, cols, "pt_id").checkpoint()
    whole = W.ward_tree(reps, d, finish=20).checkpoint()
    tree = whole.collect()
    got = {(r.lo, r.hi): r.height for r in tree}
    assert set(got) == {(a, b) for a, b, _ in merges}
    assert all(got[a, b] == pytest.approx(h, rel=1e-9) for a, b, h in merges)
    assert sum(r.round < 0 for r in tree) <= 19                # the rest came from rounds
    assert {r.id: r.cluster for r in W.cut_tree(whole, reps, 5).collect()} == labels


def test_copies_and_hot_cells(spark):
    """A third of all rows are copies of one point; cells are split at three rows."""
    rnd = np.random.default_rng(7)
    x = [(0.5, 0.5)] * 60 + [tuple(p) for p in rnd.normal(0.5, 0.02, (80, 2))] + [tuple(p) for p in rnd.uniform(0, 30, (40, 2))]
    points = dict(enumerate(x))
    merges, labels = greedy(points, 6)
    df, cols = _frame(spark, points)
    reps = W.representatives(df, cols, "pt_id").checkpoint()
    tree = W.ward_tree(reps, 2, finish=60, rows_per_split=3)
    assert {(r.lo, r.hi) for r in tree.collect()} == {(a, b) for a, b, _ in merges}
    assert _labels(W.ward(df, cols, 6, "pt_id")) == labels


def test_all_pairs_within_the_threshold_are_found_once(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, int(n), float(a), float(b)) for i, (n, a, b) in enumerate(zip(2 ** rnd.integers(0, 9, 150) + rnd.integers(0, 2, 150),
                                                                               rnd.normal(0, 1, 150), rnd.normal(0, 1, 150)))]
    clusters = spark.createDataFrame(rows, "id long, n long, x0 double, x1 double")
    got = sorted((r.lo, r.hi) for r in W._pairs(clusters, 2, 0.3, 150, 10_000).collect())
    want = sorted((a[0], b[0]) for i, a in enumerate(rows) for b in rows[i + 1:]
                  if a[1] * b[1] / (a[1] + b[1]) * ((a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2) <= 0.3)
    assert got == want and len(want) > 20


def test_defined_results_at_the_edges(spark):
    points = {1: (0.0, 0.0), 2: (0.0, 0.0), 3: (9.0, 9.0)}
    df, cols = _frame(spark, points, [(4, None, 1.0), (5, float("nan"), 1.0)])
    assert _labels(W.ward(df, cols, 2, "pt_id")) == {1: 0, 2: 0, 3: 1, 4: None, 5: None}
    assert _labels(W.ward(df, cols, 9, "pt_id")) == {1: 0, 2: 0, 3: 1, 4: None, 5: None}     # two positions, two clusters
    assert set(_labels(W.ward(df.filter("pt_id < 4"), cols, 1, "pt_id")).values()) == {0}
    assert W.ward(df.filter("pt_id > 99"), cols, 3, "pt_id").collect() == []
    clash = df.filter("pt_id < 4").withColumns({"cluster": F.lit(7), "id": F.lit(1), "n": F.lit(2), "x0": F.lit("a")})
    assert _labels(W.ward(clash, cols, 2, "pt_id")) == {1: 0, 2: 0, 3: 1}
    with pytest.raises(ValueError):
        W.ward(df, cols, 0, "pt_id")


def test_ties_have_one_result(spark):
    """A row of equal gaps: greedy Ward by the stated order, in few rounds."""
    points = {i: (float(i), 0.0) for i in range(1, 41)}
    merges, labels = greedy(points, 4)
    df, cols = _frame(spark, points)
    reps = W.representatives(df, cols, "pt_id").checkpoint()
    tree = W.ward_tree(reps, 2, finish=8).collect()
    assert {(r.lo, r.hi) for r in tree} == {(a, b) for a, b, _ in merges}
    assert max(r.round for r in tree) <= 10
    moved = df.repartition(5, F.hash("pt_id"))
    assert _labels(W.ward(moved, cols, 4, "pt_id")) == labels
