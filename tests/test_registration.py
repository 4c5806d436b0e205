"""Registration: features are finite, ICP and RANSAC recover a known small
rigid transform on a synthetic 3-D shape (a box surface with a bump)."""

import math

import numpy as np
import pytest

from sitelens.operators import cloud as CL
from sitelens.operators import registration as RG


def _shape(n=3000, seed=0):
    """Points on the six faces of a box (a shape ICP can lock onto)."""
    rnd = np.random.default_rng(seed)
    pts = rnd.random((n, 3))
    face = rnd.integers(0, 6, size=n)
    pts[np.arange(n), face // 2] = (face % 2).astype(float)
    return pts * np.array([1.0, 0.8, 0.6])


def _move(pts, ang, shift):
    r = np.array([[math.cos(ang), -math.sin(ang), 0], [math.sin(ang), math.cos(ang), 0], [0, 0, 1]])
    return pts @ r.T + np.array(shift)


def _df(spark, pts):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "pt_id long, x double, y double, z double")


def test_icp_recovers_small_transform(spark):
    tgt = _shape()
    src = _move(tgt, -0.03, (0.02, -0.015, 0.01))     # source = target moved; ICP must undo it
    tgt_n = CL.estimate_normals(_df(spark, tgt), 0.08, 30)
    res = RG.icp_align(_df(spark, src), tgt_n, max_corr=0.1, max_iter=40)
    t = np.array(res["transform"])
    moved = src @ t[:3, :3].T + t[:3, 3]
    assert np.sqrt(((moved - tgt) ** 2).sum(1)).mean() < 5e-3
    assert res["fitness"] > 0.95


def test_rigid_fit_exact():
    rnd = np.random.default_rng(1)
    ps = rnd.random((4, 3))
    pt = _move(ps, 0.3, (1.0, 2.0, 3.0))
    t = RG.rigid_fit(ps, pt)
    assert np.allclose(ps @ t[:3, :3].T + t[:3, 3], pt, atol=1e-9)


def test_fpfh_and_matches(spark):
    tgt = _shape(1500, 2)
    src = _move(tgt, 0.0, (0.0, 0.0, 0.0))
    cloud = CL.estimate_normals(_df(spark, tgt), 0.1, 30)
    f = RG.fpfh_features(cloud, 0.2, 100).toPandas()
    arr = np.stack(f["fpfh"].to_numpy())
    assert arr.shape[1] == 33 and np.isfinite(arr).all()
    # identical clouds: every point is its own mutual best match; small
    # blocks force the blocked co-grouped search path
    cloud_s = CL.estimate_normals(_df(spark, src), 0.1, 30)
    fs = cloud_s.join(RG.fpfh_features(cloud_s, 0.2, 100), "pt_id")
    ft = cloud.join(RG.fpfh_features(cloud, 0.2, 100), "pt_id")
    m = RG.mutual_matches(fs, ft, block_rows=400).toPandas()
    assert len(m) > 0.95 * len(tgt)
    assert (m["src_id"] == m["tgt_id"]).mean() > 0.95
    assert (m["fdist"] < 1e-6).all()          # sums run in any order: equal up to rounding
    assert m["src_id"].is_unique and m["tgt_id"].is_unique


def test_ordinals_contiguous(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    o = sorted(r.ord for r in RG.with_ordinal(df, "k").collect())
    assert o == list(range(1000))


def test_feature_index_is_exact_and_compares_few_pairs(spark):
    """Both directions against brute force on clustered features with copies and
    a far-off target cluster; most pairs are ruled out."""
    g = np.random.default_rng(3)
    centres = g.normal(size=(12, 33)) * 40
    xs = np.concatenate([centres[g.integers(0, 12, 900)] + g.normal(size=(900, 33)), centres[:2] * 0 + 500])
    xt = np.concatenate([centres[g.integers(0, 11, 800)] + g.normal(size=(800, 33)), xs[:20]])
    df = lambda x: spark.createDataFrame([(int(i) * 3 + 1, [float(v) for v in r]) for i, r in enumerate(x)], "pt_id long, fpfh array<double>").repartition(3)
    count = spark.sparkContext.accumulator(0)
    best = RG.argmin_per_key(RG.nearest_both_ways(df(xs), df(xt), block_rows=150, compared=count), ["side", "id"], "fdist", "other").collect()
    d = np.sqrt(((xs[:, None] - xt[None]) ** 2).sum(2))
    got = {(r["side"], r["id"]): r["other"] for r in best}
    assert got == {**{(0, i * 3 + 1): int(j) * 3 + 1 for i, j in enumerate(d.argmin(1))}, **{(1, j * 3 + 1): int(i) * 3 + 1 for j, i in enumerate(d.argmin(0))}}
    assert count.value < 0.5 * d.size
    none = spark.createDataFrame([], "pt_id long, fpfh array<double>")
    assert RG.mutual_matches(df(xs), none).count() == 0 == RG.mutual_matches(none, df(xt)).count()


def test_icp_rounds_equal_cell_joins(spark, monkeypatch):
    """Rounds over packed blocks give the equations of the join of cells, however far
    the source has moved since it was dealt, with repeated and null ids, points
    without a position and blocks that are too full."""
    g = np.random.default_rng(5)
    tgt, src = _shape(900, 1), _shape(700, 2)
    normals = g.normal(size=(900, 3))
    q = [(i // 2 * 3, *map(float, x), *map(float, n)) for i, (x, n) in enumerate(zip(tgt, normals))]      # target ids repeat
    q += [(1, *q[7][1:]), (7, None, 0.1, 0.1, 0.0, 0.0, 1.0), (8, float("nan"), 0.1, 0.1, 0.0, 0.0, 1.0)]
    tq = spark.createDataFrame(q, "nn_id long, qx double, qy double, qz double, nx double, ny double, nz double").checkpoint()
    p = [(i if i > 30 else i // 3, *map(float, x)) for i, x in enumerate(src)] + [(None, 0.5, 0.4, 0.0), (900, None, 0.0, 0.0), (901, float("nan"), 0.0, 0.0)]
    base = spark.createDataFrame(p, "pt_id long, x double, y double, z double").checkpoint()
    moves = [RG._small_transform(np.array([0.0, 0.0, a, a, 0.0, -a])) for a in (0.0, 0.004, 0.3)]
    expected = [RG._pair_equations(base, tq, t, 0.06) for t in moves]
    for rows in (100_000, 40):
        monkeypatch.setattr(RG, "ICP_BLOCK_ROWS", rows)
        rounds = RG.IcpRounds(base, tq, 0.06)
        for t, e in zip(moves, expected):
            assert e[0] > 50
            assert np.allclose(list(rounds.at_transform(t).values()), e, rtol=1e-9, atol=1e-9)
        assert (rounds.dense is not None) == (rows == 40)
    # targets without a normal, or too far apart for the cells' keys
    for more in ([(5, 0.5, 0.4, 0.0, None, 0.0, 1.0)], [(5, 1e6, 0.4, 0.0, 1.0, 0.0, 1.0)]):
        odd = tq.unionByName(spark.createDataFrame(more, tq.schema)).checkpoint()
        assert np.allclose(list(RG.IcpRounds(base, odd, 0.06).at_transform(moves[1]).values()), RG._pair_equations(base, odd, moves[1], 0.06))
    none = RG.IcpRounds(base.limit(0), tq, 0.06).at_transform(moves[0]), RG.IcpRounds(base, tq.limit(0), 0.06).at_transform(moves[0])
    assert [r["cnt"] for r in none] == [0, 0]


def test_icp_round_is_one_job(spark):
    """A round passes over the packed blocks: one job of one stage, no shuffle."""
    tgt = _shape()
    tgt_n = CL.estimate_normals(_df(spark, tgt), 0.08, 30).checkpoint()
    jobs = lambda: spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
    took = []
    for rounds in (3, 9):
        before = jobs()
        res = RG.icp_align(_df(spark, _move(tgt, -0.002, (0.002, -0.0015, 0.001))), tgt_n, max_corr=0.1, max_iter=rounds, rel_tol=-1.0)
        assert res["iterations"] == rounds and not res["converged"]
        took.append(jobs() - before)
    assert took[1] - took[0] == 6


def test_feature_groups_meet_once(spark, monkeypatch):
    """Several groups a side: copies give the smaller id, far-off features cost no
    precision, and no pair of rows is compared twice."""
    g = np.random.default_rng(6)
    xs, xt = g.normal(size=(500, 33)) * 3, g.normal(size=(300, 33)) * 3
    xt[100:140] = xs[:40]
    xt[140:180] = xs[:40]
    xs[490:], xt[290:] = xs[490:] * 1e-3 + 2_000.0, xt[290:] * 1e-3 + 2_000.0
    df = lambda x: spark.createDataFrame([(int(i) * 5 - 700, [float(v) for v in r]) for i, r in enumerate(x)], "pt_id long, fpfh array<double>").repartition(3)
    count = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(RG, "BLOCKS_TOGETHER", 2)
    near = RG.nearest_both_ways(df(xs), df(xt), block_rows=64, compared=count)
    assert near.filter("side = 0").count() == 500 * 3 and near.filter("side = 1").count() == 300 * 4
    assert count.value <= 500 * 300
    got = {(r["side"], r["id"]): (r["other"], r["fdist"]) for r in RG.argmin_per_key(near, ["side", "id"], "fdist", "other").collect()}
    d = np.sqrt(((xs[:, None] - xt[None]) ** 2).sum(2))
    for side, m in ((0, d), (1, d.T)):
        for i, row in enumerate(m):
            j = int(row.argmin())
            assert got[side, i * 5 - 700] == (j * 5 - 700, pytest.approx(row[j], abs=1e-12))


def test_inliers_are_counted_in_tiles(spark, monkeypatch):
    """Hypotheses meet the matches in tiles: a task forms no product per hypothesis."""
    monkeypatch.setattr(RG, "COUNT_TILE", (4, 16))
    g = np.random.default_rng(7)
    ps = g.normal(size=(150, 3))
    mats = np.stack([RG._small_transform(v)[:3] for v in g.normal(size=(11, 6)) * 0.2])
    pt = ps @ mats[6, :, :3].T + mats[6, :, 3] + g.normal(size=ps.shape) * 0.03
    m = spark.createDataFrame([tuple(map(float, np.r_[a, b])) for a, b in zip(ps, pt)], ", ".join(f"{s}{c} double" for s in "st" for c in "xyz")).repartition(3)
    inl, rmse, t = RG._count_inliers(m, np.arange(11) * 10, mats, 0.06)
    d2 = ((ps @ mats[6, :, :3].T + mats[6, :, 3] - pt) ** 2).sum(1)
    assert inl == (d2 <= 0.06 ** 2).sum() and rmse == pytest.approx(math.sqrt(d2[d2 <= 0.06 ** 2].mean()))
    assert np.array_equal(t[:3], mats[6])
