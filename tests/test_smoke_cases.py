"""The reference's eight smoke cases, on the fixture views."""

from pyspark.sql import functions as F

from tables import SF_MID, SF_SMALL
from sitelens.operators import cluster as K
from sitelens.operators.ranking import recommend
from sitelens.plans import common, models


def _clean(spark):
    return common.venues(spark, SF_MID)


def test_data_loads(spark):
    assert _clean(spark).count() > 10_000


def test_price_nis_present(spark):
    df = _clean(spark)
    assert "price_nis" in df.columns
    assert df.filter(F.col("price_nis").isNotNull()).count() > 0


def test_feature_cols_present(spark):
    assert not [c for c in K.FEATURE_COLS if c not in _clean(spark).columns]


def test_split_sizes_add_up(spark):
    split = models.venue_split(spark, SF_MID)
    n_train = split.filter("split = 'train'").count()
    n_test = split.filter("split = 'test'").count()
    valid = _clean(spark).dropna(subset=["rating", "price_nis"]).count()
    assert n_train > n_test and n_train + n_test == valid


def _kmeans_result(spark):
    split = models.venue_split(spark, SF_SMALL)
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    sc = K.Scaler.fit(train, K.FEATURE_COLS)
    best, scores = K.k_sweep(sc.transform(train), sc.z_cols(), "row_id", range(3, 9))
    model = K.kmeans_fit(train, K.FEATURE_COLS, best, scaler=sc)
    tr = K.silhouette_value(sc.transform(model.predict(train)), sc.z_cols(), "cluster", "row_id").value
    te = K.silhouette_value(sc.transform(model.predict(test)), sc.z_cols(), "cluster", "row_id").value
    return best, scores, model, tr, te


def test_train_kmeans_returns_scores(spark):
    best, scores, model, tr, te = _kmeans_result(spark)
    assert 3 <= best <= 8 and model.k == best
    assert 0 < tr < 1 and 0 < te < 1
    assert [k for k, _ in scores] == list(range(3, 9))


def test_predict_returns_ranked_list(spark):
    """Fit on the training rows, then predict over all venues."""
    _, _, model, _, _ = _kmeans_result(spark)
    v = common.venues(spark, SF_MID)
    q = spark.createDataFrame([(1, 32.08, 34.78, "student", 5.0)], "query_id long, lat double, lng double, "
                                                                  "persona string, max_dist_km double")
    recs = models.predict(q, v, model, k=1_000_000).orderBy("rank").toPandas()
    assert len(recs) > 0 and set(recs["cluster"]) <= set(range(model.k))
    assert recs["score"].tolist() == sorted(recs["score"].tolist(), reverse=True)


def test_train_agglomerative_returns_scores(spark):
    split = models.venue_split(spark, SF_SMALL)
    train = split.filter("split = 'train'")
    sc = K.Scaler.fit(train, K.FEATURE_COLS)
    out, info = K.ward_micro(sc.transform(train), sc.z_cols(), 4, micro=64)
    assert info == {"micro": 64, "method": "ward_micro"}
    s = K.silhouette_value(out, sc.z_cols(), "cluster", "row_id").value
    assert 0 < s < 1
    assert out.select("cluster").distinct().count() == 4


def test_predict_empty_on_impossible_location(spark):
    v = common.venues(spark, SF_MID)
    q = spark.createDataFrame([(1, 0.0, 0.0, "student", 0.1)], "query_id long, lat double, lng double, "
                                                               "persona string, max_dist_km double")
    assert recommend(q, v).count() == 0
