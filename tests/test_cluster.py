"""Clustering invariants and brute-force references."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitelens.operators import cluster as K


def _df(spark, pts):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "pt_id long, f0 double, f1 double")


def scan_dbscan(pts, eps, min_samples):
    """The usual scan-order DBSCAN: clusters grow in index order, a border
    point keeps the first cluster that reaches it."""
    n = len(pts)
    nb = [[j for j in range(n) if math.dist(pts[i], pts[j]) <= eps] for i in range(n)]
    core = [len(x) >= min_samples for x in nb]
    lab = [-1] * n
    c = 0
    for i in range(n):
        if lab[i] != -1 or not core[i]:
            continue
        stack, lab[i] = [i], c
        while stack:
            p = stack.pop()
            for q in nb[p]:
                if lab[q] == -1:
                    lab[q] = c
                    if core[q]:
                        stack.append(q)
        c += 1
    return lab, core


@pytest.mark.parametrize("eps,min_samples,seed", [(0.08, 4, 1), (0.05, 3, 2), (0.12, 6, 3)])
def test_dbscan_matches_scan_order(spark, eps, min_samples, seed):
    rnd = np.random.default_rng(seed)
    blobs = [rnd.normal(c, 0.03, size=(40, 2)) for c in [(0.2, 0.2), (0.7, 0.3), (0.5, 0.8)]]
    pts = [tuple(map(float, p)) for p in np.vstack(blobs + [rnd.random((25, 2))])]
    got = K.dbscan(_df(spark, pts), ["f0", "f1"], eps, min_samples, rows_per_split=5).collect()
    got = {r.pt_id: (r.cluster, r.is_core) for r in got}
    lab, core = scan_dbscan(pts, eps, min_samples)
    assert [got[i][0] for i in range(len(pts))] == lab
    assert [got[i][1] for i in range(len(pts))] == core


def _silhouette_numpy(x, lab):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() <= 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_silhouette_exact_and_sampled(spark):
    rnd = np.random.default_rng(9)
    x = np.vstack([rnd.normal(c, 0.1, size=(60, 2)) for c in [(0, 0), (1, 0), (0, 1)]] + [[[5.0, 5.0]]])
    lab = np.array([0] * 60 + [1] * 60 + [2] * 60 + [3])   # a singleton cluster scores 0
    df = spark.createDataFrame([(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, lab))],
                               "pt_id long, f0 double, f1 double, cluster int")
    exact = K.silhouette(df, ["f0", "f1"], "cluster", "pt_id", method="exact", block_rows=70).first()
    assert exact["method"] == "exact" and exact["n_anchors"] == len(x) and exact["stderr"] == 0
    assert exact["silhouette"] == pytest.approx(_silhouette_numpy(x, lab), abs=1e-9)
    sampled = K.silhouette(df, ["f0", "f1"], "cluster", "pt_id", method="sampled", sample_rows=60).first()
    assert sampled["method"] == "sampled" and sampled["n_anchors"] == 60
    assert abs(sampled["silhouette"] - exact["silhouette"]) < 4 * sampled["stderr"] + 1e-9


def test_fewer_than_two_clusters_scores_zero(spark):
    df = spark.createDataFrame([(i, float(i), 0.0, 0) for i in range(5)], "pt_id long, f0 double, f1 double, c int")
    assert K.silhouette_value(df, ["f0", "f1"], "c", "pt_id").value == 0.0


def test_nearest_center_ties_to_smallest_index(spark):
    df = spark.createDataFrame([(1, 0.5, 0.0)], "pt_id long, f0 double, f1 double")
    r = df.select(K.nearest_center(["f0", "f1"], [[1.0, 0.0], [0.0, 0.0], [5.0, 5.0]]).alias("c")).first()
    assert r["c"] == 0


def test_weighted_ward_separates_blobs():
    rnd = np.random.default_rng(0)
    x = np.vstack([rnd.normal(c, 0.05, size=(20, 2)) for c in [(0, 0), (3, 0), (0, 3)]])
    g = K.weighted_ward(x, np.ones(len(x)), 3)
    assert len(set(g)) == 3
    for blk in range(3):
        assert len(set(g[blk * 20:(blk + 1) * 20])) == 1


def test_kmeans_invariants(spark):
    rnd = np.random.default_rng(4)
    x = np.vstack([rnd.normal(c, 0.2, size=(50, 2)) for c in [(0, 0), (4, 0), (0, 4)]])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "pt_id long, f0 double, f1 double")
    m1 = K.kmeans_fit(df, ["f0", "f1"], 3)
    m2 = K.kmeans_fit(df, ["f0", "f1"], 3)
    p1 = m1.predict(df)
    assert p1.filter(F.col("cluster").isNull()).count() == 0
    assert p1.select("cluster").distinct().count() == 3
    assert sorted(map(tuple, np.round(m1.centers, 9))) == sorted(map(tuple, np.round(m2.centers, 9)))


def test_cluster_labels_dedup(spark):
    cents = spark.createDataFrame([(0, 50.0, 4.5), (1, 50.4, 4.6), (2, 50.6, 4.7), (3, 30.0, 2.0)],
                                  "cluster int, price_nis double, rating double")
    th = {"price_33": 40.0, "price_67": 45.0, "rating_33": 3.0, "rating_67": 4.0}
    lab = {r.cluster: r.label for r in K.cluster_labels(cents, th).collect()}
    assert lab[0] == "Good & Expensive"
    assert lab[1] == "Good & Expensive (₪50)"          # half-even: 50.4 -> 50
    assert lab[2] == "Good & Expensive (₪51)"
    assert lab[3] == "Below Average & Affordable"
    assert len(set(lab.values())) == 4


def test_dbscan_copy_group_matches_scan_order(spark):
    """A third of the points are copies of one point: same labels as the
    scan-order algorithm on the uncollapsed points."""
    rnd = np.random.default_rng(8)
    base = [tuple(map(float, p)) for p in np.vstack([rnd.normal((0.3, 0.3), 0.04, size=(60, 2)), rnd.random((30, 2))])]
    pts = base + [(0.31, 0.29)] * 45 + [(0.9, 0.9)] * 3          # a big copy group and a small one
    got = {r.pt_id: (r.cluster, r.is_core) for r in K.dbscan(_df(spark, pts), ["f0", "f1"], 0.05, 4).collect()}
    lab, core = scan_dbscan(pts, 0.05, 4)
    assert [got[i][0] for i in range(len(pts))] == lab
    assert [got[i][1] for i in range(len(pts))] == core


def test_global_rank_matches_sort(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 10007).alias("v"))
    got = {r.v: r._rank for r in K.global_rank(df, "v").collect()}
    want = {v: i for i, v in enumerate(sorted(got))}
    assert got == want


@pytest.mark.parametrize("gap", [0.095, 0.105])
def test_dbscan_link_only_through_boundary_pair(spark, gap):
    """Two dense strips joined (or not) only by a point pair near eps:
    no sure sub-cell link can see it, so the boundary pair check must."""
    rnd = np.random.default_rng(3)
    left = [(float(x), float(y)) for x, y in zip(rnd.uniform(-0.3, 0.0, 80), rnd.uniform(0, 0.3, 80))]
    right = [(float(x), float(y)) for x, y in zip(rnd.uniform(gap, gap + 0.3, 80), rnd.uniform(0, 0.3, 80))]
    pts = left + [(0.0, 0.15)] + right + [(gap, 0.15)]
    got = {r.pt_id: (r.cluster, r.is_core) for r in K.dbscan(_df(spark, pts), ["f0", "f1"], 0.1, 3).collect()}
    lab, core = scan_dbscan(pts, 0.1, 3)
    assert [got[i][0] for i in range(len(pts))] == lab
    assert [got[i][1] for i in range(len(pts))] == core
    assert len(set(lab) - {-1}) == (1 if gap < 0.1 else 2)


def _plain_lloyd(x, centers, tolerance=K.KMEANS_TOLERANCE):
    for step in range(1, K.KMEANS_MAX_ITER + 1):
        near = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[near == j].mean(axis=0) if (near == j).any() else c for j, c in enumerate(centers)])
        moved, centers = np.abs(new - centers).max(), new
        if moved <= tolerance:
            return centers, step
    return centers, step


@pytest.mark.parametrize("shell_rows", [0, 40, 400, 10_000])
def test_lloyd_shares_passes_and_takes_the_steps_of_plain_kmeans(spark, monkeypatch, shell_rows):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(4000, 2)) + rng.integers(0, 2, (4000, 1))
    z = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "row_id long, f0 double, f1 double").repartition(4).cache()
    starts = {k: x[:k].tolist() for k in (3, 5)}
    passes, kind = [], type(z)
    pass_over = kind.mapInPandas
    monkeypatch.setattr(kind, "mapInPandas", lambda self, *a, **b: passes.append(1) or pass_over(self, *a, **b))
    found = K.lloyd(z, ["f0", "f1"], starts, shell_rows=shell_rows)
    for k, start in starts.items():
        centers, steps = _plain_lloyd(x, np.array(start))
        assert found[k][1:] == (steps, True)
        assert np.allclose(found[k][0], centers, rtol=0, atol=1e-9)
    most = max(f[1] for f in found.values())
    assert len(passes) == most if shell_rows == 0 else len(passes) < most


def test_lloyd_sums_of_many_tasks(spark, monkeypatch):
    """Far places, a centre without rows, sums that a shuffle adds up."""
    monkeypatch.setattr(K, "LLOYD_COLLECT_TASKS", 1)
    x = np.array([[0.0], [0.1], [0.2], [10.0], [10.3], [50.0]] * 5)
    z = spark.createDataFrame([(i, float(r[0])) for i, r in enumerate(x)], "row_id long, f0 double").repartition(3).cache()
    start = [[0.0], [11.0], [-900.0]]
    centers, steps, still = K.lloyd(z, ["f0"], {3: start}, shell_rows=6)[3]
    want, n = _plain_lloyd(x, np.array(start))
    assert still and steps == n and np.allclose(centers, want) and centers[2] == [-900.0]


def test_fit_from_a_sweeps_centres_is_at_rest(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rng.normal(size=(600, 2)))], "row_id long, f0 double, f1 double").cache()
    sc = K.Scaler.fit(df, ["f0", "f1"])
    best, _, swept = K.k_sweep_models(sc.transform(df), sc.z_cols(), "row_id", range(3, 5))
    plain, rested = K.kmeans_fit(df, ["f0", "f1"], best, scaler=sc), K.kmeans_fit(df, ["f0", "f1"], best, scaler=sc, start=swept[best])
    assert np.allclose(plain.centers, rested.centers, rtol=0, atol=1e-9)
    assert rested.info == {"iterations": 1, "converged": True} and plain.info["iterations"] > 1


def test_scores_of_several_labellings_are_each_ones_score(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, *map(float, r), i % 3, i % 2, 0) for i, r in enumerate(rng.normal(size=(90, 2)))],
                               "row_id long, f0 double, f1 double, a int, b int, one int").cache()
    got = K.silhouette_values(df, ["f0", "f1"], ["a", "one", "b"], "row_id", sample_rows=40)
    for label, score in zip(["a", "one", "b"], got):
        alone = K.silhouette_value(df, ["f0", "f1"], label, "row_id", sample_rows=40)
        assert np.isclose(score.value, alone.value) and score[1:3] == alone[1:3]
    assert got[1] == (0.0, "sampled", 0, None)


def test_components_rounds_start_at_written_tables(spark, monkeypatch):
    """A long chain takes several rounds; their plans don't build on each other."""
    n, plans, apart = 300, [], K.apart
    monkeypatch.setattr(K, "apart", lambda df: plans.append(len(df._jdf.queryExecution().toString())) or apart(df))
    edges = spark.createDataFrame([((i * 7) % n, ((i + 1) * 7) % n) for i in range(n - 1)] + [(1000, 1001)], "src long, dst long")
    nodes = spark.createDataFrame([(i,) for i in [*range(n), 1000, 1001, 2000]], "node long")
    got = {r["node"]: r["comp"] for r in K.connected_components(edges, nodes).collect()}
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000, 2000: 2000}
    assert len(plans) > 9 and max(plans[6:]) <= 2 * max(plans[:3])
