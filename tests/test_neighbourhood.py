"""Neighbourhoods in blocks: the pair tables' neighbours, whatever the blocks, and few rows moved."""

import numpy as np
import pytest

from sitelens.operators import cloud as CL
from sitelens.operators import neighbourhood as N
from sitelens.operators import registration as RG
from sitelens.operators.spatial import knn_radius


def _cloud(spark, g, n=1000, shift=3_630_000.0):
    p = g.random((n, 3)) * np.array([2.0, 2.0, 0.1])
    p[: n // 4] = np.round(p[: n // 4], 1)                  # ties and copies
    p[n // 2: n // 2 + 200] = 0.5 + g.random((200, 3)) * 0.02    # a dense spot
    rows = [(int(i) * 7 + 3, *map(float, q + shift), *map(float, m)) for i, (q, m) in enumerate(zip(p, g.normal(size=(n, 3))))]
    rows += [(999_001, None, 1.0, 1.0, 0.0, 0.0, 1.0), (999_002, float("nan"), 1.0, 1.0, 0.0, 0.0, 1.0)]
    return spark.createDataFrame(rows, "pt_id long, x double, y double, z double, nx double, ny double, nz double").repartition(3).checkpoint()


def _listing():
    """Made here, so that workers get the function itself."""
    def listed(rows, x, a, b, dist):
        ids = rows["pt_id"].to_numpy()
        at = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        return a[at], {"near": np.split(ids[b], at[1:])}
    return listed


@pytest.mark.parametrize("max_rows", [None, 250])
def test_neighbours_are_those_of_the_pair_table(spark, max_rows):
    cloud = _cloud(spark, np.random.default_rng(4))

    def pairs(p):
        from pyspark.sql import functions as F
        nb = knn_radius(p, CL.XYZ, 0.1, 12)
        return nb.groupBy(F.col("a").alias("pt_id")).agg(F.sort_array(F.collect_list(F.struct("nn_rank", "b"))).getField("b").alias("near"))

    want = {r["pt_id"]: list(r["near"]) for r in pairs(cloud).collect()}
    got = N.over_neighbours(cloud, 0.1, 12, [], _listing(), "near array<long>", pairs, max_rows).collect()
    assert len(got) == len(want) == 1000
    assert {r["pt_id"]: list(r["near"]) for r in got} == want


def test_moments_and_features_of_blocks_and_pairs_agree(spark, monkeypatch):
    cloud = _cloud(spark, np.random.default_rng(5), n=420)
    found = []
    for limit in (N.MAX_BLOCK_ROWS, 0):                     # 0: every block goes by pair tables
        monkeypatch.setattr(N, "MAX_BLOCK_ROWS", limit or 1)
        f = {r["pt_id"]: r["fpfh"] for r in RG.fpfh_features(cloud, 0.1, 20).collect()}
        m = {r["pt_id"]: (r["nx"], r["ny"], r["nz"]) for r in CL.estimate_normals(cloud.drop("nx", "ny", "nz"), 0.1, 20).collect()}
        found.append((f, m))
    (f, m), (g, n) = found
    assert f.keys() == g.keys() and m.keys() == n.keys() and len(f) == 422
    assert max(abs(a - b) for k in f for a, b in zip(f[k], g[k])) < 1e-6
    assert [k for k in m if (m[k][0] is None) != (n[k][0] is None)] == []


def test_repeated_ids_go_by_pair_tables(spark):
    cloud = _cloud(spark, np.random.default_rng(6), n=400)
    twice = cloud.unionByName(cloud.limit(5))
    asked = []
    N.over_neighbours(twice, 0.1, 12, [], _listing(), "near array<long>",
                      lambda p: asked.append(p) or p.selectExpr("pt_id", "array(pt_id) AS near"))
    assert asked


def test_pairs_of_points_are_not_shuffled(spark):
    """The plan of the features held a join of all pairs before."""
    cloud = _cloud(spark, np.random.default_rng(7), n=400)
    from unittest import mock
    with mock.patch.object(RG, "knn_radius", side_effect=AssertionError), mock.patch.object(CL, "knn_radius", side_effect=AssertionError):
        assert RG.fpfh_features(cloud, 0.1, 20).count() == 402
        assert CL.estimate_normals(cloud.drop("nx", "ny", "nz"), 0.1, 20).count() == 402


def test_a_source_is_sent_to_a_pivot_once(spark, monkeypatch):
    """Small blocks used to repeat every source per block of a cell's targets."""
    g = np.random.default_rng(8)
    df = lambda x: spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in enumerate(x)], "pt_id long, fpfh array<double>").repartition(2)
    xs, xt = g.normal(size=(300, 33)), g.normal(size=(310, 33))
    d = ((xs[:, None] - xt[None]) ** 2).sum(2)
    for block, together in ((20, 1), (20, 100)):
        monkeypatch.setattr(RG, "BLOCKS_TOGETHER", together)
        got = {r["src_id"]: r["tgt_id"] for r in RG.feature_nn(df(xs), df(xt), block_rows=block).collect()}
        assert got == {i: int(j) for i, j in enumerate(d.argmin(1))}
