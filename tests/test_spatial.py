"""Neighbour joins against brute force, including hot-cell salting,
poles, the antimeridian, identical points and empty sides."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitelens.operators import cloud as CL
from sitelens.operators.spatial import eps_pairs, knn_radius, nn_join, radius_join


def hav(lat1, lng1, lat2, lng2):
    s_lat = math.sin(math.radians(lat2 - lat1) / 2)
    s_lng = math.sin(math.radians(lng2 - lng1) / 2)
    a = s_lat * s_lat + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * (s_lng * s_lng)
    return 12742.0 * math.asin(math.sqrt(min(1.0, a)))


def _venues(spark, pts):
    return spark.createDataFrame([(i, la, lo) for i, (la, lo) in enumerate(pts)], "row_id long, lat double, lng double")


def _queries(spark, qs):
    return spark.createDataFrame([(i, la, lo, r) for i, (la, lo, r) in enumerate(qs)],
                                 "query_id long, lat double, lng double, max_dist_km double")


def _brute_radius(pts, qs):
    out = set()
    for qi, (qla, qlo, r) in enumerate(qs):
        for vi, (la, lo) in enumerate(pts):
            if hav(qla, qlo, la, lo) <= r:
                out.add((qi, vi))
    return out


@pytest.mark.parametrize("rows_per_split", [200_000, 3])
def test_radius_join_matches_brute_force(spark, rows_per_split):
    rnd = random.Random(7)
    pts = [(32 + rnd.random() * 0.3, 34.9 + rnd.random() * 0.3) for _ in range(300)]
    pts += [(32.1, 35.0)] * 20  # a hot spot of identical venues
    qs = [(32 + rnd.random() * 0.3, 34.9 + rnd.random() * 0.3, rnd.choice([0.5, 1.0, 3.0, 8.0])) for _ in range(40)]
    qs += [(32.1, 35.0, 0.0)]  # zero radius hits the identical points
    got = radius_join(_queries(spark, qs), _venues(spark, pts), rows_per_split=rows_per_split)
    got = {(r.query_id, r.row_id) for r in got.select("query_id", "row_id").collect()}
    assert got == _brute_radius(pts, qs)


def test_radius_join_pole_and_antimeridian(spark):
    pts = [(89.99, 10.0), (89.99, -170.0), (0.0, 179.999), (0.0, -179.999), (-89.995, 0.0), (0.0, 0.0)]
    qs = [(89.995, 100.0, 5.0), (0.0, -179.9995, 1.0), (-89.99, 180.0, 2.0), (0.0, 0.0, 0.0)]
    got = radius_join(_queries(spark, qs), _venues(spark, pts), cell_deg=0.01)
    got = {(r.query_id, r.row_id) for r in got.select("query_id", "row_id").collect()}
    assert got == _brute_radius(pts, qs)


def _brute_nn(q, t):
    out = {}
    for i, p in q.items():
        best = min(t.items(), key=lambda kv: (sum((a - b) ** 2 for a, b in zip(p, kv[1])), kv[0]))
        out[i] = (best[0], math.sqrt(sum((a - b) ** 2 for a, b in zip(p, best[1]))))
    return out


@pytest.mark.parametrize("rows_per_split", [200_000, 5])
def test_nn_join_matches_brute_force(spark, rows_per_split):
    rnd = np.random.default_rng(3)
    t = {i: tuple(map(float, rnd.random(3))) for i in range(200)}
    t.update({1000 + i: (0.5, 0.5, 0.5) for i in range(5)})            # identical targets: tie -> smallest id
    t.update({2000: (30.0, 30.0, 30.0)})                                 # far outlier
    q = {i: tuple(map(float, rnd.random(3) * 1.2 - 0.1)) for i in range(150)}
    q.update({900: (0.5, 0.5, 0.5), 901: (25.0, -3.0, 40.0), 902: (0.25, 0.25, 0.25)})  # on cell edges too
    qdf = spark.createDataFrame([(i, *p) for i, p in q.items()], "pt_id long, x double, y double, z double")
    tdf = spark.createDataFrame([(i, *p) for i, p in t.items()], "pt_id long, x double, y double, z double")
    got = {r.pt_id: (r.nn_id, r.nn_dist) for r in
           nn_join(qdf, tdf, ["x", "y", "z"], cell=0.25, rows_per_split=rows_per_split).collect()}
    want = _brute_nn(q, t)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0]
        assert got[k][1] == pytest.approx(want[k][1], abs=1e-12)


def test_nn_join_empty_target_and_single_point(spark):
    q = spark.createDataFrame([(1, 0.0, 0.0, 0.0)], "pt_id long, x double, y double, z double")
    empty = spark.createDataFrame([], "pt_id long, x double, y double, z double")
    r = nn_join(q, empty, ["x", "y", "z"]).collect()
    assert len(r) == 1 and r[0].nn_id is None
    one = spark.createDataFrame([(7, 3.0, 4.0, 0.0)], "pt_id long, x double, y double, z double")
    r = nn_join(q, one, ["x", "y", "z"]).collect()
    assert r[0].nn_id == 7 and r[0].nn_dist == pytest.approx(5.0)


def test_eps_pairs_and_knn_radius(spark):
    rnd = np.random.default_rng(5)
    pts = {i: tuple(map(float, rnd.random(2))) for i in range(250)}
    df = spark.createDataFrame([(i, *p) for i, p in pts.items()], "pt_id long, f0 double, f1 double")
    eps = 0.08
    got = {(r.a, r.b) for r in eps_pairs(df, ["f0", "f1"], eps, rows_per_split=4).collect()}
    want = {(a, b) for a in pts for b in pts
            if (pts[a][0] - pts[b][0]) ** 2 + (pts[a][1] - pts[b][1]) ** 2 <= eps * eps}
    assert got == want
    k = knn_radius(df, ["f0", "f1"], eps, 3).collect()
    by_a = {}
    for r in k:
        by_a.setdefault(r.a, []).append((r.dist, r.b))
    for a, lst in by_a.items():
        full = sorted((math.dist(pts[a], pts[b]), b) for b in pts if math.dist(pts[a], pts[b]) <= eps)
        assert [b for _, b in sorted(lst)] == [b for _, b in full[:3]]


def _triangle_grid(a, b, c, n=300):
    # dense barycentric sample of the triangle (an upper bound on distance)
    u, v = np.meshgrid(np.linspace(0, 1, n + 1), np.linspace(0, 1, n + 1))
    keep = (u + v) <= 1 + 1e-12
    u, v = u[keep], v[keep]
    return a[None, :] + u[:, None] * (b - a)[None, :] + v[:, None] * (c - a)[None, :]


def test_mesh_distance_matches_brute_force(spark):
    rnd = np.random.default_rng(11)
    tris = [(i, *map(float, rnd.random(9))) for i in range(6)]
    pts = [(i, *map(float, rnd.random(3) * 1.4 - 0.2)) for i in range(12)]
    tdf = spark.createDataFrame(tris, "tri_id long, ax double, ay double, az double, bx double, by_ double, "
                                      "bz double, cx double, cy double, cz double")
    pdf = spark.createDataFrame(pts, "pt_id long, x double, y double, z double")
    got = {r.pt_id: r.deviation_m for r in CL.mesh_distance(pdf, tdf, cell=0.1).collect()}
    grids = np.vstack([_triangle_grid(np.array(t[1:4]), np.array(t[4:7]), np.array(t[7:10])) for t in tris])
    for pid, x, y, z in pts:
        want = float(np.min(np.linalg.norm(grids - np.array([x, y, z])[None, :], axis=1)))
        assert got[pid] <= want + 1e-9 and got[pid] == pytest.approx(want, abs=5e-3)


def test_nn_join_hot_group_of_copies(spark):
    """A third of the targets are copies of one point, next to a hot spot of
    distinct points: results equal brute force (ties -> smallest id)."""
    rnd = np.random.default_rng(21)
    t = {i: tuple(map(float, rnd.random(3))) for i in range(300)}
    t.update({5000 + i: (0.4, 0.4, 0.4) for i in range(200)})                       # group of copies
    t.update({9000 + i: tuple(map(float, 0.6 + rnd.random(3) * 1e-3)) for i in range(400)})  # dense spot
    q = {i: tuple(map(float, rnd.random(3))) for i in range(120)}
    q.update({800: (0.4, 0.4, 0.4), 801: (0.6005, 0.6005, 0.6005)})
    qdf = spark.createDataFrame([(i, *p) for i, p in q.items()], "pt_id long, x double, y double, z double")
    tdf = spark.createDataFrame([(i, *p) for i, p in t.items()], "pt_id long, x double, y double, z double")
    got = {r.pt_id: (r.nn_id, r.nn_dist) for r in nn_join(qdf, tdf, ["x", "y", "z"], rows_per_split=50).collect()}
    want = _brute_nn(q, t)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0]
        assert got[k][1] == pytest.approx(want[k][1], abs=1e-12)


def test_knn_radius_dense_spot_staged(spark):
    """A dense spot (staged radii) next to sparse points equals brute force."""
    rnd = np.random.default_rng(17)
    pts = {i: tuple(map(float, rnd.random(2))) for i in range(150)}
    pts.update({1000 + i: tuple(map(float, 0.5 + rnd.random(2) * 0.01)) for i in range(300)})
    df = spark.createDataFrame([(i, *p) for i, p in pts.items()], "pt_id long, f0 double, f1 double")
    k = knn_radius(df, ["f0", "f1"], 0.1, 5).collect()
    by_a = {}
    for r in k:
        by_a.setdefault(r.a, []).append((r.nn_rank, r.b))
    assert set(by_a) == set(pts)
    for a, lst in by_a.items():
        full = sorted((math.dist(pts[a], pts[b]), b) for b in pts if math.dist(pts[a], pts[b]) <= 0.1)
        assert [b for _, b in sorted(lst)] == [b for _, b in full[:5]]


def test_far_queries_meet_few_targets(spark):
    """Queries far from all targets descend the cells: exact, and far fewer
    pairs than queries x targets."""
    from sitelens.operators.spatial import box_candidates
    rnd = np.random.default_rng(9)
    t = np.concatenate([rnd.random((1900, 3)) * [2.0, 2.0, 0.05], rnd.random((100, 3)) * 0.01 + 0.5])
    q = np.concatenate([rnd.random((60, 3)) * 50 + 100, rnd.random((40, 3)) * 5 - 40, rnd.random((40, 3))])
    tdf = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(t)], "pt_id long, x double, y double, z double")
    qdf = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(q)], "pt_id long, x double, y double, z double")
    got = {r["pt_id"]: (r["nn_id"], r["nn_dist"]) for r in nn_join(qdf, tdf, ["x", "y", "z"]).collect()}
    d = np.sqrt(((q[:, None] - t[None]) ** 2).sum(-1))
    assert len(got) == len(q)
    for i in range(len(q)):
        assert abs(got[i][1] - d[i].min()) < 1e-9 and got[i][0] == int(d[i].argmin())
    far = qdf.filter("pt_id < 100").selectExpr("pt_id AS _qid", "x AS q_x0", "y AS q_x1", "z AS q_x2")
    items = tdf.selectExpr("pt_id AS _tid", "0 AS _class", *[f"{c} AS {p}_x{i}" for p in ("t", "lo", "hi") for i, c in enumerate("xyz")])
    assert box_candidates(far, items, 3, 0.05, 2.0).count() < 0.1 * 100 * len(t)


def test_grid_pruning_is_exact(spark):
    """Dense cells, a hot spot, circles that hold cells, tiny and huge radii,
    unknown personas: the pruned top k equals ranking all candidates."""
    from sitelens.operators.ranking import candidates, rank_candidates, recommend
    rnd = np.random.default_rng(5)
    n = 3000
    lat = np.where(rnd.random(n) < 0.4, 32.08, 32.0 + rnd.random(n) * 0.2)
    lng = np.where(rnd.random(n) < 0.4, 34.80, 34.7 + rnd.random(n) * 0.2)
    venues = spark.createDataFrame(
        [(i, float(lat[i]), float(lng[i]), "v", "c", float(rnd.integers(10, 51)) / 10 if i % 17 else None, float(rnd.integers(30, 60)), "u")
         for i in range(n)], "row_id long, lat double, lng double, name string, city string, rating double, price_nis double, google_maps_url string")
    personas = ["student", "quality", "nobody", None]
    queries = spark.createDataFrame(
        [(i, 32.0 + float(rnd.random()) * 0.2, 34.7 + float(rnd.random()) * 0.2, personas[i % 4], float([0.1, 2, 6, 15, 400][i % 5])) for i in range(60)],
        "query_id long, lat double, lng double, persona string, max_dist_km double")
    cols = ["query_id", "rank", "row_id", "score", "distance_km"]
    got = sorted(map(tuple, recommend(queries, venues, 10, cell_deg=0.01, rows_per_split=100).select(*cols).collect()))
    want = sorted(map(tuple, rank_candidates(candidates(queries, venues, cell_deg=0.01)).select(*cols).collect()))
    assert got == want and len(got) > 400


def test_mesh_distance_with_a_slab_and_far_points(spark):
    """One 50 m slab among centimetre triangles, points near and far."""
    rnd = np.random.default_rng(7)
    base = rnd.random((300, 3)) * [1.0, 1.0, 0.2]
    tri = [np.stack([b, b + rnd.random(3) * 0.02, b + rnd.random(3) * 0.02]) for b in base]
    tri.append(np.array([[-25.0, -25.0, -1.0], [25.0, -25.0, -1.0], [0.0, 25.0, -1.0]]))
    pts = np.concatenate([rnd.random((60, 3)), rnd.random((30, 3)) * 80 - 40])
    tdf = spark.createDataFrame([(i, *map(float, t.ravel())) for i, t in enumerate(tri)], "tri_id long, " + ", ".join(f"{c} double" for c in CL.TRI))
    pdf = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "pt_id long, x double, y double, z double")
    got = {r["pt_id"]: r["deviation_m"] for r in CL.mesh_distance(pdf, tdf).collect()}

    def dist(p, t):
        a, ab, ac = t[0], t[1] - t[0], t[2] - t[0]
        n = np.cross(ab, ac)
        v, w = np.linalg.lstsq(np.stack([ab, ac], 1), p - a, rcond=None)[0]
        best = abs(np.dot(p - a, n)) / np.linalg.norm(n) if v >= 0 and w >= 0 and v + w <= 1 else np.inf
        for i in range(3):
            s, e = t[i], t[(i + 1) % 3]
            u = np.clip(np.dot(p - s, e - s) / np.dot(e - s, e - s), 0, 1)
            best = min(best, np.linalg.norm(p - s - u * (e - s)))
        return best

    for i, p in enumerate(pts):
        assert abs(got[i] - min(dist(p, t) for t in tri)) < 1e-9, i


def test_clouds_of_one_table_stay_apart(spark):
    """Two clouds with repeating point ids and overlapping positions, and a
    group of copies: the same as each cloud by itself."""
    rnd = np.random.default_rng(11)
    pts = [(c, i, *map(float, rnd.random(3) * [1, 1, 0.1])) for c in (7, 8) for i in range(300)]
    pts += [(7, 300 + i, 0.5, 0.5, 0.05) for i in range(60)]
    schema = "cloud_id long, pt_id long, x double, y double, z double"
    both = spark.createDataFrame(pts, schema)
    src = both.withColumn("x", F.col("x") + 0.01 * F.col("cloud_id"))
    normals = {(r["cloud_id"], r["pt_id"]): (r["nx"], r["ny"], r["nz"]) for r in CL.estimate_normals(both, 0.2, 20).collect()}
    dist = {(r["cloud_id"], r["pt_id"]): (r["nn_id"], r["deviation_m"]) for r in CL.cloud_distance(src, both).collect()}
    fit = {r["cloud_id"]: r["n_inliers"] for r in CL.align_quality(src, both, 0.05).collect()}
    for c in (7, 8):
        one, moved = both.filter(f"cloud_id = {c}").drop("cloud_id"), src.filter(f"cloud_id = {c}").drop("cloud_id")
        n = {r["pt_id"]: (r["nx"], r["ny"], r["nz"]) for r in CL.estimate_normals(one, 0.2, 20).collect()}
        assert len(n) == sum(k[0] == c for k in normals)
        assert all(np.allclose(normals[c, i], v, atol=1e-7) for i, v in n.items())
        d = {r["pt_id"]: (r["nn_id"], r["deviation_m"]) for r in CL.cloud_distance(moved, one).collect()}
        assert {i: dist[c, i] for i in d} == d
        assert fit[c] == CL.align_quality(moved, one, 0.05).first()["n_inliers"]


def test_copies_share_their_neighbours(spark):
    """Hybrid kNN with a third of the points at one place, against brute force."""
    rnd = np.random.default_rng(13)
    x = np.concatenate([rnd.random((80, 3)), np.tile([[0.5, 0.5, 0.5]], (40, 1))])
    ids = rnd.permutation(len(x))
    df = spark.createDataFrame([(int(i), *map(float, p)) for i, p in zip(ids, x)], "pt_id long, x double, y double, z double")
    got = {}
    for r in knn_radius(df, ["x", "y", "z"], 0.4, 7).collect():
        got.setdefault(r["a"], []).append((r["nn_rank"], r["b"]))
    for k, i in enumerate(ids):
        d = np.sqrt(((x - x[k]) ** 2).sum(1))
        order = sorted((v, int(ids[j])) for j, v in enumerate(d) if v <= 0.4)[:7]
        assert [b for _, b in sorted(got[i])] == [b for _, b in order]


def _surface(spark, corners):
    return spark.createDataFrame([(i, *map(float, np.ravel(c))) for i, c in corners], "tri_id long, " + ", ".join(f"{c} double" for c in CL.TRI))


def test_mesh_sample_spaces_exactly_n_points(spark):
    """A slab beside small triangles at a radius that drops many of the first draw."""
    rnd = np.random.default_rng(3)
    small = [(i, b + np.array([[0, 0, 0], [0.05, 0, 0], [0, 0.05, 0]])) for i, b in enumerate(rnd.random((40, 3)))]
    tris = _surface(spark, [*small, (99, [[0, 0, 2], [3, 0, 2], [0, 3, 2]])])
    for radius in (0.06, None):
        got = CL.mesh_sample(tris, 500, thin_radius=radius).toPandas()
        assert len(got) == 500 and got["pt_id"].is_unique
        p = got[["x", "y", "z"]].to_numpy()
        d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1)) + np.eye(len(p)) * 9
        assert d.min() > (radius or 0.05)
    again = CL.mesh_sample(tris.repartition(3), 500).toPandas().sort_values("pt_id").reset_index(drop=True)
    assert again.equals(got.sort_values("pt_id").reset_index(drop=True))
    with pytest.raises(ValueError, match="of 500 points"):
        CL.mesh_sample(tris, 500, thin_radius=0.5)


def test_mesh_sample_keeps_points_dropped_ones_beat(spark):
    """The thinning is the greedy choice in hash order: maximal, so every
    point that it drops lies near a kept one."""
    tris = _surface(spark, [(7, [[0, 0, 0], [1, 0, 0], [0, 1, 0]])])
    pts = CL._draw(CL._with_area(tris), 0.5, 0.5, 300, 42).withColumn("_p", F.struct("tri_id", "_i")).checkpoint()
    kept = {r["_i"] for r in CL._spaced(pts, 0.08, 42).collect()}
    rows = pts.withColumn("h", CL._turn("_p", 42)).orderBy("h", "_p").collect()
    want = []
    for r in rows:
        if all((r["x"] - q["x"]) ** 2 + (r["y"] - q["y"]) ** 2 > 0.08 ** 2 for q in want):
            want.append(r)
    assert kept == {r["_i"] for r in want} and len(want) < 200


def test_mesh_sample_ids_of_large_triangles(spark):
    """More than 2^20 points on one triangle, its neighbour's ids after them."""
    tris = _surface(spark, [(0, [[0, 0, 0], [19, 0, 0], [0, 1, 0]]), (1, [[0, 0, 1], [1, 0, 1], [0, 1, 1]])])
    drawn = CL._draw(CL._with_area(tris), 10.0, 9.5, 1_200_000, 42)
    got = CL._point_ids(drawn, 1_200_000, 1).agg(F.count("pt_id"), F.countDistinct("pt_id"), F.countDistinct("tri_id")).first()
    assert got[0] == got[1] and abs(got[0] - 1_200_000) <= 2 and got[2] == 2
    far = _surface(spark, [(2 ** 62, [[0, 0, 0], [1, 0, 0], [0, 1, 0]])])
    assert {r["pt_id"] for r in CL.mesh_sample(far, 50).collect()} == set(range(50))


def test_mesh_distance_keeps_clouds_apart(spark):
    """Equal point and triangle ids in two clouds, and a cloud without a mesh."""
    tri = [[0.0, 0, 0], [1.0, 0, 0], [0.0, 1, 0]]
    rows = [(c, 3, *[float(v + (dz if k == 2 else 0)) for p in tri for k, v in enumerate(p)]) for c, dz in ((1, 0.0), (2, 1.0))]
    tris = spark.createDataFrame(rows, "cloud_id long, tri_id long, " + ", ".join(f"{c} double" for c in CL.TRI))
    pts = spark.createDataFrame([(1, 7, .2, .2, 1.0), (2, 7, .2, .2, 1.0), (2, 8, .2, .2, 51.0), (3, 7, .2, .2, 1.0)],
                                "cloud_id long, pt_id long, x double, y double, z double")
    d = CL.mesh_distance(pts, tris)
    got = {(r["cloud_id"], r["pt_id"]): (None if r["deviation_m"] is None else round(r["deviation_m"], 9), r["tri_id"]) for r in d.collect()}
    assert got == {(1, 7): (1.0, 3), (2, 7): (0.0, 3), (2, 8): (50.0, 3), (3, 7): (None, None)}
    report = {(r["cloud_id"], r["pt_id"]): r["alert"] for r in CL.deviation_report(d, 0.05).collect()}
    assert report[(1, 7)] and not report[(2, 7)]


def test_cover_of_wide_circles(spark):
    """Rows a click, whatever the radius, and every pair found: wide circles,
    at the poles and across the antimeridian, over venues all around."""
    from sitelens.operators.spatial import held_probe, probe_cells
    rnd = random.Random(11)
    pts = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(2500)] + [(90.0, 0.0), (-90.0, 10.0), (0.0, 180.0), (0.0, -180.0)]
    qs = [(32.8, 35.0, 500.0), (0.0, 179.9, 3000.0), (89.0, 0.0, 400.0), (-89.9, 100.0, 2500.0), (10.0, -179.99, 900.0), (45.0, 7.0, 19_000.0),
          (60.0, 170.0, 1500.0), (32.0, 35.0, 1.0), (-75.0, -170.0, 5000.0), (5.0, 5.0, 25_000.0)]
    q, v = _queries(spark, qs), _venues(spark, pts)
    got = {(r.query_id, r.row_id) for r in radius_join(q, v, cell_deg=0.015).select("query_id", "row_id").collect()}
    assert got == _brute_radius(pts, qs)
    per = {r["query_id"]: r["count"] for r in probe_cells(q, 0.015).groupBy("query_id").count().collect()}
    assert max(per.values()) <= 400 and per[0] <= 250
    # blocks inside the circle became one cell: two levels for one query
    assert len(held_probe(probe_cells(q.filter("query_id = 1"), 0.015), 10 ** 6)[1]) == 2


def test_many_clicks_at_one_place_are_dealt_out(spark):
    """A third of all clicks at one spot: no key of the join holds them all."""
    from sitelens.operators.spatial import CELL_KEYS, build_cells, held_probe, hot_keys, probe_cells, split_both
    rnd = random.Random(12)
    pts = [(32.8 + rnd.gauss(0, 0.02), 35.0 + rnd.gauss(0, 0.02)) for _ in range(300)]
    qs = [(32.8, 35.0, 1.5)] * 200 + [(32.8 + rnd.gauss(0, 0.05), 35.0 + rnd.gauss(0, 0.05), 1.5) for _ in range(100)]
    q, v = _queries(spark, qs), _venues(spark, pts)
    probe, levels, asked = held_probe(probe_cells(q, 0.015), 40)
    build = build_cells(v, 0.015, levels=levels)
    build, probe, keys = split_both(build, probe, CELL_KEYS, hot_keys(build, CELL_KEYS, 40), asked)
    assert probe.groupBy(*keys).count().agg(F.max("count")).first()[0] < 120
    pairs = {(r.query_id, r.row_id) for r in radius_join(q, v, cell_deg=0.015, rows_per_split=40).select("query_id", "row_id").collect()}
    assert pairs == _brute_radius(pts, qs)
