"""Tables that grow with the input meet in shuffle joins, and ranked lists meet few venues however dense these are."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitelens.operators import cloud as CL
from sitelens.operators import spatial as SP
from sitelens.operators.cluster import dbscan
from sitelens.operators.ranking import candidates, rank_candidates, recommend, venue_grid
from sitelens.operators.registration import icp_align
from sitelens.operators.spatial import eps_pairs, knn_radius
from sitelens.plans import models as M

VENUE = "row_id long, lat double, lng double, name string, city string, rating double, price_nis double, google_maps_url string"
QUERY = "query_id long, lat double, lng double, persona string, max_dist_km double"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def points(spark, tmp_path_factory):
    """A small parquet file, whose size Spark knows."""
    at = str(tmp_path_factory.mktemp("points") / "p.parquet")
    xyz = np.random.default_rng(1).random((300, 3)) * 0.4
    spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(xyz)], "pt_id long, x double, y double, z double").coalesce(1).write.parquet(at)
    return spark.read.parquet(at)


def test_points_and_their_probe_cells_are_not_broadcast(points):
    found = {"eps_pairs": eps_pairs(points, CL.XYZ, 0.05, id_col="pt_id"), "knn_radius": knn_radius(points, CL.XYZ, 0.1, 10),
             "estimate_normals": CL.estimate_normals(points, 0.1, 10), "cloud_distance": CL.cloud_distance(points, points),
             "dbscan": dbscan(points, CL.XYZ, 0.1, 4)}
    for name, df in found.items():
        assert "BroadcastHashJoin" not in _plan(df), name


def test_mesh_distance_reads_its_pairs_once(points):
    p = points.withColumn("k", F.floor(F.col("pt_id") / 3))
    corner = [p.filter(F.col("pt_id") % 3 == i).select("k", *[F.col(a).alias(n) for a, n in zip(CL.XYZ, names)])
              for i, names in enumerate([("ax", "ay", "az"), ("bx", "by_", "bz"), ("cx", "cy", "cz")])]
    tri = corner[0].join(corner[1], "k").join(corner[2], "k").withColumnRenamed("k", "tri_id")
    plan = _plan(CL.mesh_distance(points, tri))
    # the least distance was joined back to all pairs before, formed a second time for that
    assert "_best" not in plan


def test_icp_joins_by_shuffle(points, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    seen, join = [], DataFrame.join
    monkeypatch.setattr(DataFrame, "join", lambda self, *a, **k: seen.append(join(self, *a, **k)) or seen[-1])
    normals = points.withColumns({"nx": F.lit(0.0), "ny": F.lit(0.6), "nz": F.lit(0.8)})
    icp_align(points, normals, max_corr=0.05, max_iter=1)
    assert seen and all("BroadcastHashJoin" not in _plan(df) for df in seen)


@pytest.fixture(scope="module")
def town(spark):
    """6,000 venues on 60 places within 3 km, and 24 queries at 6 of them."""
    rnd = np.random.default_rng(2)
    at = np.stack([32.0 + rnd.random(60) * 0.03, 34.8 + rnd.random(60) * 0.03], 1)
    venues = [(i, *map(float, at[i % 60]), "v", "c", float(rnd.integers(30, 51)) / 10, float(rnd.integers(40, 60)), "u") for i in range(6000)]
    queries = [(i, *map(float, at[i % 6]), ["student", "quality", "nobody", None][i % 4], [0.2, 1.0, 9.0][i % 3]) for i in range(24)]
    return spark.createDataFrame(venues, VENUE), spark.createDataFrame(queries, QUERY)


def _rows(df, *cols):
    return sorted(map(tuple, df.select("query_id", "rank", "row_id", *cols).collect()))


def test_lists_meet_few_of_many_venues(town):
    venues, queries = town
    assert venue_grid(venues, 0.005, 10, levels=(0, 1, 2)).leaves.count() < 0.5 * 2 * 6000
    assert _rows(recommend(queries, venues, 10), "score") == _rows(rank_candidates(candidates(queries, venues), 10), "score")


def test_persona_eligible_ranks_among_those_that_pass(town):
    venues, queries = town
    want = rank_candidates(M.persona_eligible(candidates(queries, venues)), 10)
    assert _rows(M.recommend_eligible(queries, venues, 10), "score") == _rows(want, "score")


def test_baseline_distance_meets_few_of_many_venues(town, monkeypatch):
    venues, queries = town
    met = []
    join = M.radius_join
    monkeypatch.setattr(M, "radius_join", lambda q, v: met.append(join(q, v)) or met[-1])
    got = _rows(M.baseline_distance(queries, venues), "distance_km")
    w = F.row_number().over(Window.partitionBy("query_id").orderBy("distance_km", "row_id"))
    want = _rows(candidates(queries, venues).withColumn("rank", w).filter("rank <= 10"), "distance_km")
    assert got == want
    assert sum(df.count() for df in met) < 6000


def test_nearest_neighbours_of_crowded_cells(spark, monkeypatch):
    """Queries that share cells meet the targets through the cells: their rows are not listed in others."""
    rnd = np.random.default_rng(5)
    q = [(i, *map(float, p)) for i, p in enumerate(rnd.uniform(0, 1, (600, 3)) * [1, 1, 0.2])] + [(600, None, 0.5, 0.1), (601, 9.0, 9.0, 0.0)]
    t = [(i, float(x), float(y), 0.0) for i, (x, y) in enumerate((a / 4, b / 4) for a in range(5) for b in range(80))]
    schema = "pt_id long, x double, y double, z double"
    probes, split = [], SP.split_hot_cells
    monkeypatch.setattr(SP, "split_hot_cells", lambda b, p, *a: probes.append((p.count(), b.count())) or split(b, p, *a))
    got = {r["pt_id"]: r for r in SP.nn_join(spark.createDataFrame(q, schema), spark.createDataFrame(t, schema), ["x", "y", "z"]).collect()}
    assert probes[0][0] <= 602 and probes[0][1] < 5_000
    tx = np.array([r[1:] for r in t])
    assert set(got) == {r[0] for r in q if r[1] is not None}
    for i, *at in q:
        if at[0] is not None:
            d = np.sqrt(((tx - at) ** 2).sum(1))
            assert got[i]["nn_dist"] == pytest.approx(d.min()) and d[got[i]["nn_id"]] == pytest.approx(d.min())
