"""Foreign CSV files, odd numbers, empty inputs and degenerate geometry."""

import math

import numpy as np
import pandas as pd
import pytest

from sitelens.functions.scalar import to_double
from sitelens.operators import clean as C
from sitelens.operators import cloud as CL
from sitelens.operators import cluster as K
from sitelens.operators import profile as P
from sitelens.plans.models import persona_eligible
from sitelens.session import ensure_checkpoint_dir, scratch_path
from sitelens.sources import io

HEADER = ("latitude,longitude,city,name,rating,reviews_count,price_turkey_shawarma_pita,price_cow_shawarma_pita,"
          "price_turkey_shawarma_laffa,price_cow_shawarma_laffa,price_falafel_pita,price_falafel_laffa,price_small_fries,"
          "price_big_fries,price_drink,car_park_nearby,price_source,price_notes,google_maps_url")
ROWS = ['32.08,34.78,"Tel Aviv, Yafo","Abu ""X"" grill",4.5,120,46,49,50,55,20,24,10,15,8,True,estimated,"a, b",https://m/1',
        '32.10,34.80,Haifa,Plain,12d,inf,5f,49,50,55,20,24,10,15,8,False,verified,,https://m/2',
        'bad,34.81,Haifa,No place,4.0,99999999999,46,1e999,50,55,20,24,10,15,8,,verified,,https://m/3']


def test_venue_csv_by_header_name(spark, tmp_path):
    (tmp_path / "v.csv").write_text("\n".join([HEADER, *ROWS]) + "\n", encoding="utf-8")
    raw = io.read_venues_csv(spark, str(tmp_path / "v.csv"))
    first = raw.filter("latitude = 32.08").first()
    assert (first["longitude"], first["city"], first["name"], first["rating"]) == (34.78, "Tel Aviv, Yafo", 'Abu "X" grill', "4.5")
    assert first["row_id"] is not None and first["price_small_fries"] == "10" and first["price_notes"] == "a, b"
    assert raw.filter("latitude IS NULL").first()["name"] == "No place"
    clean = {r["name"]: r for r in C.clean_venues(raw).collect()}
    assert set(clean) == {'Abu "X" grill', "Plain"}
    plain = clean["Plain"]
    assert plain["rating"] is None and plain["reviews_count"] is None and plain["price_nis"] is None and plain["ratings_count"] == 0
    assert clean['Abu "X" grill']["car_park_nearby"] is True and clean['Abu "X" grill']["price_nis"] == 46.0


def test_csv_quotes_survive_other_readers(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, "plain")], "k long, name string").coalesce(1)
    io.write_csv(df, str(tmp_path / "out"))
    back = pd.concat(pd.read_csv(p) for p in (tmp_path / "out").glob("part-*.csv"))
    assert sorted(back["name"]) == ['a "b", c', "plain"]


@pytest.mark.parametrize("text,want", [("12d", None), ("5f", None), ("inf", None), ("-Infinity", None), ("NaN", None), ("1e999", None),
                                       (" 12.5 ", 12.5), ("-.5", -0.5), ("3.", 3.0), ("1e3", 1000.0), ("", None), ("N/A", None), ("0x10", None)])
def test_strict_numbers(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(to_double("t").alias("v")).first()["v"] == want


def test_large_review_count_does_not_stop_the_clean(spark):
    df = spark.createDataFrame([(1, 32.0, 34.0, "a", "c", "99999999999", "True")],
                               "row_id long, latitude double, longitude double, name string, city string, reviews_count string, car_park_nearby string")
    assert C.clean_venues(df).first()["ratings_count"] is None


def test_empty_tables(spark):
    rows = P.null_profile(spark.createDataFrame([], "a long, b string")).collect()
    assert [(r["column"], r["non_null"], r["null_pct"]) for r in rows] == [("a", 0, None), ("b", 0, None)]
    cloud = spark.createDataFrame([(1, 0.0, 0.0, 0.0)], "pt_id long, x double, y double, z double")
    got = CL.align_quality(cloud.limit(0), cloud, 1.0).first()
    assert got["fitness"] is None and got["n_inliers"] == 0


def test_null_city_wins_no_place(spark):
    df = spark.createDataFrame([(None, 5.0)] * 9 + [("a", 4.0)] * 6 + [("b", 4.5)] * 4, "city string, rating double")
    assert [r["city"] for r in P.city_rating_top(df, 5, 20).collect()] == ["a"]


def test_unknown_persona_uses_the_default(spark):
    df = spark.createDataFrame([("student", 4.5, 50.0), ("other", 4.5, 50.0), (None, 4.5, 50.0), ("other", 3.0, 50.0)],
                               "persona string, rating double, price_nis double")
    assert persona_eligible(df).count() == 3


def test_silhouette_without_distances(spark):
    df = spark.createDataFrame([(i, 1.0, i % 2) for i in range(6)], "pt_id long, f double, c int")
    for method in ("exact", "sampled"):
        assert K.silhouette(df, ["f"], "c", "pt_id", method=method).first()["silhouette"] == 0.0
    with pytest.raises(ValueError):
        K.silhouette(df, ["f"], "c", "pt_id", method="whatever")


def test_method_does_not_follow_the_row_count(spark):
    for n in (20, 400):
        df = spark.createDataFrame([(i, float(i % 5), i % 2) for i in range(n)], "pt_id long, f double, c int")
        assert K.silhouette(df, ["f"], "c", "pt_id", method="sampled", sample_rows=50).first()["method"] == "sampled"
        exact = K.silhouette(df, ["f"], "c", "pt_id", method="exact", block_rows=30).first()
        assert exact["method"] == "exact" and exact["n_anchors"] == n


def test_missing_model_is_none_and_broken_model_raises(spark, tmp_path):
    assert K.CentroidModel.load(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        K.CentroidModel.load(spark, str(tmp_path / "bad"))


def test_degenerate_triangles(spark):
    tri = [(1, [0, 0, 0], [0, 0, 0], [1, 0, 0]), (2, [5, 0, 0], [5, 0, 0], [5, 0, 0]), (3, [0, 5, 0], [1, 5, 0], [3, 5, 0])]
    tris = spark.createDataFrame([(i, *map(float, a + b + c)) for i, a, b, c in tri], "tri_id long, " + ", ".join(f"{c} double" for c in CL.TRI))
    pts = [(1, 0.5, 1.0, 0.0), (2, 5.0, 0.0, 2.0), (3, 2.5, 6.0, 0.0), (4, -1.0, 0.0, 0.0), (5, 2.0, 0.0, 0.0)]
    got = {r["pt_id"]: r["deviation_m"] for r in CL.mesh_distance(spark.createDataFrame(pts, "pt_id long, x double, y double, z double"), tris).collect()}

    def segment(p, a, b):
        p, a, b = (np.array(v, float) for v in (p, a, b))
        t = np.clip(np.dot(p - a, b - a) / max(np.dot(b - a, b - a), 1e-300), 0, 1)
        return np.linalg.norm(p - a - t * (b - a))

    for i, *p in pts:
        want = min(segment(p, a, b) for _, *v in tri for a in v for b in v)
        assert math.isclose(got[i], want, abs_tol=1e-12), i


def test_shared_checkpoint_folder_is_required_off_local_mode(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    monkeypatch.setattr("sitelens.session.ship_package", lambda s: None)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_group_quantiles_against_numpy(spark):
    from sitelens.operators.quantiles import group_quantiles, quantiles

    rnd = np.random.default_rng(3)
    rows = [(f"g{i % 7}" if i % 11 else None, float(v)) for i, v in enumerate(rnd.integers(0, 40, 900))] + [("g1", None), ("none", None), ("one", 5.0)]
    rows += [("hot", float(v)) for v in rnd.integers(0, 10 ** 6, 900)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    names = {"a": 0.25, "b": 0.5, "c": 0.67, "z": 1.0}
    got = {r["g"]: r for r in group_quantiles(df, ["g"], "v", names).collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vs in groups.items():
        for n, q in names.items():
            assert math.isclose(got[g][n], np.quantile(vs, q), abs_tol=1e-9), (g, n)
    whole = quantiles(df, "v", {"m": 0.5})
    assert math.isclose(whole["m"], np.quantile([v for _, v in rows if v is not None], 0.5), abs_tol=1e-9)
    assert quantiles(df.limit(0), "v", {"m": 0.5}) == {"m": None}


def test_impute_group_median_keeps_rows(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, "a", None), (4, "b", None), (5, None, None), (6, None, 9.0)],
                               "row_id long, city string, price double")
    got = {r["row_id"]: (r["price"], r["price_imputed"]) for r in C.impute_group_median(df, "price", ["city"]).collect()}
    assert got == {1: (1.0, False), 2: (3.0, False), 3: (2.0, True), 4: (None, False), 5: (None, False), 6: (9.0, False)}


def test_attach_is_a_join_whatever_the_group_sizes(spark):
    """Small and many groups, a hot one, hot and small ones without a row, null keys."""
    from sitelens.operators.grouping import attach
    rows = [(i, "hot" if i % 3 == 0 else "lost" if i % 3 == 1 and i < 1500 else f"g{i % 700}", i % 2) for i in range(6000)] + [(9000 + i, None, 0) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, a string, b int")
    groups = spark.createDataFrame([("hot", 0, 1.0), ("hot", 1, 2.0)] + [(f"g{i}", 0, float(i)) for i in range(650)], "a string, b int, v double")
    for how in ("inner", "left"):
        want = sorted(map(tuple, df.join(groups, ["a", "b"], how).select("id", "a", "b", "v").collect()), key=str)
        for limit in (100_000, 0):
            got = sorted(map(tuple, attach(df, groups, ["a", "b"], how, limit).select("id", "a", "b", "v").collect()), key=str)
            assert got == want and len(want) > 2000
