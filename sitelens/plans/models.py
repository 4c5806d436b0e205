"""Model plans: split, scaling, centroid models, silhouette, DBSCAN, Ward,
labels, prediction and baselines (sections 2.6-2.7), with oracles where a
deterministic model makes SQL possible.

k-means draws its start by seeded hashes and steps to its fixpoint; the SQL
draws the same start and takes the same steps in a recursive CTE, so every plan
that fits or serves a model is compared by value.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.geo import HAIFA_BBOX, haversine_km, sub_area
from sitelens.functions.hashing import hash32_sql, unit_hash_sql
from sitelens.operators import clean as C
from sitelens.operators import cluster as K
from sitelens.operators import profile as P
from sitelens.operators import ward as W
from sitelens.operators.ranking import (DEFAULT_PERSONA, PERSONA_WEIGHTS, display_round, label_order_key, persona_score,
                                        recommend, top_k_per_group)
from sitelens.operators.spatial import apart, nn_join, radius_join
from sitelens.plans import common
from sitelens.plans.explore import DEFAULT_POINT
from sitelens.plans.explore import _DIST_DEFAULT as _DIST_DEFAULT_SQL
from sitelens.plans.recommend import pairs_sql, score_sql
from sitelens.plans.registry import add
from sitelens.sources.fixtures import with_views

SEED = 42
TEST_FRACTION = 0.30
K_VENUES = 4
K_POINTS = 6
PT_COLS = ["f0", "f1", "f2"]


# Columns of a score in a result table: value, method, anchors, standard error.
SCORE_COLS = "{0} double, {0}_method string, {0}_anchors long, {0}_stderr double"


def r6(c: str) -> F.Column:
    return F.round(F.col(c), 6).alias(c)


# ---------------------------------------------------------------- Spark side

def eligible_venues(spark: SparkSession, sf: str, cols=K.FEATURE_COLS, venues: DataFrame | None = None) -> DataFrame:
    v = venues if venues is not None else common.venues(spark, sf)
    return C.eligible(v, ["rating", "price_nis"] if cols == K.FEATURE_COLS else cols)


def model_venues(spark: SparkSession, sf: str) -> DataFrame:
    """What the models read of the clean venues, cleaned once: the scaler, the
    fit, the thresholds and the prediction each read it again."""
    return common.venues(spark, sf).select("row_id", "lat", "lng", "price_nis", "rating", "reviews_count").checkpoint()


def venue_split(spark: SparkSession, sf: str, cols=K.FEATURE_COLS, venues: DataFrame | None = None) -> DataFrame:
    return K.split_train_test(eligible_venues(spark, sf, cols, venues), "row_id", TEST_FRACTION, SEED)


def haifa_venues(spark: SparkSession, sf: str) -> DataFrame:
    return C.bbox_filter(common.venues(spark, sf))


def venue_model(spark: SparkSession, sf: str, venues: DataFrame | None = None) -> tuple[K.CentroidModel, DataFrame]:
    """The venue model: train-split scaler and k-means at its fixpoint."""
    split = venue_split(spark, sf, venues=venues)
    train = split.filter(F.col("split") == "train")
    return K.kmeans_fit(train, K.FEATURE_COLS, K_VENUES, SEED), split


def region_model_fitted(spark: SparkSession, sf: str) -> tuple[K.CentroidModel, DataFrame]:
    v = K.split_train_test(C.eligible(haifa_venues(spark, sf), K.REGION_FEATURE_COLS), "row_id", TEST_FRACTION, SEED)
    return K.kmeans_fit(v.filter(F.col("split") == "train"), K.REGION_FEATURE_COLS, K_VENUES, SEED), v


def venue_labels(spark: SparkSession, sf: str, fitted=None, venues: DataFrame | None = None) -> DataFrame:
    model, _ = fitted or venue_model(spark, sf, venues)
    cents = model.centroid_frame(spark).select("cluster", "price_nis", "rating")
    th = P.label_thresholds(venues if venues is not None else common.venues(spark, sf)).first().asDict()
    return K.cluster_labels(cents, th)


def region_labels_df(spark: SparkSession, sf: str, fitted=None) -> DataFrame:
    model, _ = fitted or region_model_fitted(spark, sf)
    cents = model.centroid_frame(spark).select("cluster", "price_nis", "rating", "lat").withColumn("area", sub_area("lat"))
    th = P.label_thresholds(haifa_venues(spark, sf)).first().asDict()
    return K.cluster_labels(cents, th, area_col="area")


def points_split(spark: SparkSession, sf: str) -> DataFrame:
    return K.split_train_test(common.cluster_points(spark, sf), "pt_id", TEST_FRACTION, SEED)


def points_assigned(spark: SparkSession, sf: str) -> DataFrame:
    pts = common.cluster_points(spark, sf)
    centers = K.seeded_centers(pts, PT_COLS, K_POINTS, "pt_id", SEED)
    return pts.withColumn("cluster", K.nearest_center(PT_COLS, centers))


# ---- registered ----------------------------------------------------------

def q_split_train_test(spark, sf):
    return venue_split(spark, sf).select("row_id", "split")


def q_split_stratified(spark, sf):
    v = eligible_venues(spark, sf).select("row_id", "city")
    return K.split_exact(v, "row_id", TEST_FRACTION, SEED, ["city"]).select("row_id", "split")


def q_standard_scale(spark, sf):
    split = venue_split(spark, sf)
    sc = K.Scaler.fit(split.filter(F.col("split") == "train"), K.FEATURE_COLS)
    return sc.transform(split).select("row_id", "split", *[r6(c) for c in sc.z_cols()])


def q_centroid_assign(spark, sf):
    return points_assigned(spark, sf).select("pt_id", F.col("cluster").cast("int").alias("cluster"))


def q_kmeans_assign(spark, sf):
    split = venue_split(spark, sf, venues=model_venues(spark, sf))
    model = K.kmeans_fit(split.filter(F.col("split") == "train"), K.FEATURE_COLS, K_VENUES, SEED)
    return model.predict(split).select("row_id", "split", F.col("cluster").cast("int").alias("cluster"))


def q_k_sweep(spark, sf):
    split = venue_split(spark, sf, venues=model_venues(spark, sf))
    train = split.filter(F.col("split") == "train")
    sc = K.Scaler.fit(train, K.FEATURE_COLS)
    best, scores = K.k_sweep(sc.transform(train), sc.z_cols(), "row_id", range(3, 9), SEED)
    out = spark.createDataFrame([(k, s.value, s.method, s.anchors, s.stderr, k == best) for k, s in scores],
                                f"k int, {SCORE_COLS.format('silhouette')}, best boolean")
    return out.withColumns({c: F.round(c, 6) for c in ("silhouette", "silhouette_stderr")})


def q_silhouette_exact(spark, sf):
    s = K.silhouette(points_assigned(spark, sf), PT_COLS, "cluster", "pt_id", method="exact")
    return s.select(r6("silhouette"), "n_anchors", "method")


def q_silhouette_sampled(spark, sf):
    s = K.silhouette(points_assigned(spark, sf), PT_COLS, "cluster", "pt_id", method="sampled", sample_rows=500)
    return s.select(r6("silhouette"), "n_anchors", r6("stderr"))


def q_silhouette_squared(spark, sf):
    v = K.silhouette_squared(points_assigned(spark, sf), PT_COLS, "cluster")
    return spark.createDataFrame([(v,)], "silhouette_sq double").select(r6("silhouette_sq"))


def q_dbscan(spark, sf):
    return K.dbscan(common.cluster_points(spark, sf), PT_COLS, eps=0.5, min_samples=5, id_col="pt_id")


def dbscan_assign(train_labels: DataFrame, train_pts: DataFrame, test_pts: DataFrame, cols) -> DataFrame:
    """Test points take the label of their nearest core training point (M7)."""
    core = train_pts.join(apart(train_labels.filter("is_core").select("pt_id", "cluster")), "pt_id")
    nn = nn_join(test_pts, core, cols, q_id="pt_id", t_id="pt_id")
    return nn.join(apart(core.select(F.col("pt_id").alias("nn_id"), "cluster")), "nn_id").select("pt_id", "cluster")


def q_dbscan_assign(spark, sf):
    sp = points_split(spark, sf)
    train, test = sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "test")
    labels = K.dbscan(train, PT_COLS, eps=0.5, min_samples=5, id_col="pt_id")
    return dbscan_assign(labels, train, test, PT_COLS)


def q_ward_cluster(spark, sf):
    train = points_split(spark, sf).filter(F.col("split") == "train")
    return W.ward(train, PT_COLS, K_POINTS, "pt_id").select("pt_id", "cluster")


def q_ward_tree(spark, sf):
    """Every merge of exact Ward: hi joins lo (smallest ids) at height."""
    train = points_split(spark, sf).filter(F.col("split") == "train")
    reps = W.representatives(train, PT_COLS, "pt_id").checkpoint()
    return W.ward_tree(reps, len(PT_COLS)).select("lo", "hi", r6("height"))


def q_ward_micro(spark, sf):
    sp = points_split(spark, sf).filter(F.col("split") == "train")
    out, info = K.ward_micro(sp, PT_COLS, K_POINTS, micro=64, seed=SEED, id_col="pt_id")
    return out.select("pt_id", "cluster", F.lit(info["method"]).alias("method"), F.lit(info["micro"]).alias("micro"))


def q_ward_assign(spark, sf):
    """Test rows take the label of their nearest training row (M9); the
    training labels here are the deterministic centroid assignment."""
    lab = points_assigned(spark, sf)
    sp = K.split_train_test(lab, "pt_id", TEST_FRACTION, SEED)
    train, test = sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "test")
    nn = nn_join(test, train, PT_COLS, q_id="pt_id", t_id="pt_id")
    return nn.join(apart(train.select(F.col("pt_id").alias("nn_id"), F.col("cluster").cast("int").alias("cluster"))),
                   "nn_id").select("pt_id", "nn_id", "cluster")


def compare_algorithms(split: DataFrame, cols, id_col: str = "row_id", eps: float = 0.5, min_samples: int = 5,
                       ks=range(3, 9), method: str = "sampled", sample_rows: int = 10_000, micro: int = 256) -> DataFrame:
    """KMeans, DBSCAN and micro-cluster Ward on one split, one metrics row each
    (M10). ``method`` names the silhouette that scores all of them."""
    spark = split.sparkSession
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    sc = K.Scaler.fit(train, cols)
    zc = sc.z_cols()
    tr_z, te_z = sc.transform(train).cache(), sc.transform(test).cache()
    best_k, _, swept = K.k_sweep_models(tr_z, zc, id_col, ks, 42, method, sample_rows)

    def score(df: DataFrame) -> K.Score:
        return K.silhouette_value(df, zc, "cluster", id_col, method, sample_rows)

    km = K.kmeans_fit(tr_z, cols, best_k, 42, scaler=sc, id_col=id_col, start=swept[best_k])
    ward_tr, _ = K.ward_micro(tr_z, zc, best_k, micro=micro, id_col=id_col)
    ward_tr = ward_tr.cache()
    # the training rows' two labellings share the distances of their scores
    km_train, ward_train = K.silhouette_values(km.predict(ward_tr, "_kmeans"), zc, ["_kmeans", "cluster"], id_col, method, sample_rows)
    rows = [("KMeans", best_k, *km_train, *score(km.predict(te_z)), None)]
    db = K.dbscan(tr_z.withColumnRenamed(id_col, "pt_id"), zc, eps, min_samples, id_col="pt_id")
    db = db.withColumnRenamed("pt_id", id_col).cache()
    n_tr = db.count()
    noise_pct = 100.0 * db.filter(F.col("cluster") == -1).count() / max(1, n_tr)
    db_tr = tr_z.join(apart(db.filter(F.col("cluster") >= 0)), id_col)
    core = tr_z.select(id_col, *zc).join(apart(db.filter("is_core").select(id_col, "cluster")), id_col).checkpoint()
    if core.limit(1).count():
        nn = nn_join(te_z, core, zc, q_id=id_col, t_id=id_col)
        db_te = te_z.join(apart(nn.join(apart(core.select(F.col(id_col).alias("nn_id"), "cluster")), "nn_id")
                                .select(id_col, "cluster")), id_col)
        db_test = score(db_te)
    else:
        db_test = K.Score(0.0, method, 0, None)
    rows.append(("DBSCAN", None, *score(db_tr), *db_test, noise_pct))
    nn = nn_join(te_z, ward_tr, zc, q_id=id_col, t_id=id_col)
    ward_te = te_z.join(apart(nn.join(apart(ward_tr.select(F.col(id_col).alias("nn_id"), "cluster")), "nn_id")
                              .select(id_col, "cluster")), id_col)
    rows.append((f"Agglomerative (micro={micro})", best_k, *ward_train, *score(ward_te), None))
    out = spark.createDataFrame(rows, f"algorithm string, k int, {SCORE_COLS.format('train_silhouette')}, "
                                      f"{SCORE_COLS.format('test_silhouette')}, noise_pct double")
    return out.withColumn("kpi_pass", F.col("test_silhouette") >= 0.45)


def q_compare_algorithms(spark, sf):
    # not from ``model_venues``: micro-cluster Ward draws its start on the layout of the cleaned venues
    return compare_algorithms(venue_split(spark, sf), K.FEATURE_COLS)


def q_cluster_labels(spark, sf):
    return venue_labels(spark, sf, venues=model_venues(spark, sf)).select(F.col("cluster").cast("int").alias("cluster"), "label",
                                          r6("price_nis"), r6("rating"))


def q_region_labels(spark, sf):
    return region_labels_df(spark, sf).select(F.col("cluster").cast("int").alias("cluster"), "label",
                                              r6("price_nis"), r6("rating"), r6("lat"))


def q_region_model(spark, sf):
    """Regional k-means on price, rating, lat, lng (M12): sweep, fit, scores."""
    v = K.split_train_test(C.eligible(haifa_venues(spark, sf), K.REGION_FEATURE_COLS), "row_id", TEST_FRACTION, SEED)
    train, test = v.filter(F.col("split") == "train"), v.filter(F.col("split") == "test")
    sc = K.Scaler.fit(train, K.REGION_FEATURE_COLS, fill_zero=False)
    best, scores, swept = K.k_sweep_models(sc.transform(train), sc.z_cols(), "row_id", range(3, 9), SEED)
    model = K.kmeans_fit(train, K.REGION_FEATURE_COLS, best, SEED, scaler=sc, start=swept[best])
    tr = sc.transform(model.predict(train))
    te = sc.transform(model.predict(test))
    row = ("KMeans-Haifa", best, *K.silhouette_value(tr, sc.z_cols(), "cluster", "row_id"),
           *K.silhouette_value(te, sc.z_cols(), "cluster", "row_id"))
    out = spark.createDataFrame([row], f"algorithm string, k int, {SCORE_COLS.format('train_silhouette')}, "
                                       f"{SCORE_COLS.format('test_silhouette')}")
    return out.withColumns({c: F.round(c, 6) for p in ("train", "test") for c in (f"{p}_silhouette", f"{p}_silhouette_stderr")})


def _clustered(venues: DataFrame, model: K.CentroidModel, labels: DataFrame | None) -> tuple[DataFrame, list[str]]:
    """Eligible venues with the model's cluster and its label."""
    clustered = model.predict(C.eligible(venues, ["price_nis", "rating"]))
    if labels is None:
        return clustered, ["cluster"]
    return clustered.join(F.broadcast(labels.select("cluster", "label")), "cluster", "left"), ["cluster", "label"]


def predict(queries: DataFrame, venues: DataFrame, model: K.CentroidModel, labels: DataFrame | None = None,
            k: int = 10, label: str | None = None) -> DataFrame:
    """M16/M17 for all queries at once: the ranked top k with cluster and
    label, of the venues with one ``label`` if it is given. The cluster does
    not enter the score."""
    clustered, extra = _clustered(venues, model, labels)
    if label is not None:
        clustered = clustered.filter(F.col("label") == F.lit(label))
    return recommend(queries, clustered, k, extra_cols=extra)


def q_predict(spark, sf):
    # the clean table feeds the fit, the labels, the cell size and the join:
    # materialise it once (reliable checkpoint) instead of re-cleaning per job
    venues = common.venues(spark, sf).checkpoint()
    fitted = venue_model(spark, sf, venues)
    out = predict(common.clicks(spark, sf), venues, fitted[0], venue_labels(spark, sf, fitted, venues))
    return display_round(out).select("query_id", "rank", "row_id", "distance_km", "score",
                                     F.col("cluster").cast("int").alias("cluster"), "label")


def q_predict_region(spark, sf):
    fitted = region_model_fitted(spark, sf)
    out = predict(common.clicks(spark, sf), haifa_venues(spark, sf), fitted[0], region_labels_df(spark, sf, fitted))
    return display_round(out).select("query_id", "rank", "row_id", "distance_km", "score",
                                     F.col("cluster").cast("int").alias("cluster"), "label")


def q_cluster_counts(spark, sf):
    venues = model_venues(spark, sf)
    model, split = fitted = venue_model(spark, sf, venues)
    lab = venue_labels(spark, sf, fitted, venues)
    return (model.predict(split).join(F.broadcast(lab.select("cluster", "label")), "cluster")
            .groupBy("label").agg(F.count(F.lit(1)).alias("venues")))


def q_label_order(spark, sf):
    lab = venue_labels(spark, sf, venues=model_venues(spark, sf))
    return lab.select("label", *label_order_key("label"))


def q_filter_cluster_label(spark, sf):
    """Ranked lists kept only for one chosen label (F7): the label of the
    cluster with the smallest id."""
    venues = common.venues(spark, sf).checkpoint()
    fitted = venue_model(spark, sf, venues)
    lab = venue_labels(spark, sf, fitted, venues)
    chosen = lab.orderBy("cluster").first()["label"]
    ranked = predict(common.clicks(spark, sf), venues, fitted[0], lab, label=chosen)
    return display_round(ranked).select("query_id", "rank", "row_id", "score", "label")


def q_persona_score(spark, sf):
    v = C.eligible(C.build_features(common.venues(spark, sf), 31.5, 34.9), ["price_nis", "rating"])
    per = v.withColumn("persona", F.explode(F.array(F.lit("student"), F.lit("quality"))))
    return per.select("row_id", "persona", F.round(persona_score("persona"), 6).alias("score"))


# Persona thresholds stated in the UI text (off by default).
PERSONA_THRESHOLDS = {"student": {"min_rating": 4.0, "max_price": 52.0}, "quality": {"min_rating": 4.8, "max_price": None}}


def persona_eligible(df: DataFrame, persona_col: str = "persona") -> DataFrame:
    """Optional persona thresholds (F9), as a CASE filter per row. An unknown
    or null persona has those of the default persona, as in the weights."""
    def passes(t: dict):
        c = F.col("rating") >= F.lit(t["min_rating"])
        return c if t["max_price"] is None else c & (F.col("price_nis") <= F.lit(t["max_price"]))

    cond = None
    for name, t in PERSONA_THRESHOLDS.items():
        hit = F.col(persona_col) == name
        cond = F.when(hit, passes(t)) if cond is None else cond.when(hit, passes(t))
    return df.filter(cond.otherwise(passes(PERSONA_THRESHOLDS[DEFAULT_PERSONA])))


def recommend_eligible(queries: DataFrame, venues: DataFrame, k: int = 10) -> DataFrame:
    """``recommend`` among the venues that pass the query's persona thresholds:
    every persona's queries are ranked against those of its own."""
    v = C.eligible(venues, ["price_nis", "rating"]).checkpoint()
    known = F.col("persona").isin(*PERSONA_THRESHOLDS)
    own = F.when(known, F.col("persona")).otherwise(F.lit(DEFAULT_PERSONA))
    lists = [recommend(queries.filter(own == F.lit(p)), persona_eligible(v.withColumn("persona", F.lit(p))).drop("persona"), k)
             for p in PERSONA_THRESHOLDS]
    return functools.reduce(DataFrame.unionByName, lists)


def q_persona_eligible(spark, sf):
    ranked = recommend_eligible(common.clicks(spark, sf), common.venues(spark, sf), 10)
    return display_round(ranked).select("query_id", "rank", "row_id", "score")


# The parts of a query's radius that are searched one after another.
BASELINE_SHARES = (1 / 64, 1 / 16, 1 / 4, 1 / 2, 1)


def baseline_distance(queries: DataFrame, venues: DataFrame, k: int = 10) -> DataFrame:
    """Nearest-first top k per query with the persona score as
    ``baseline_score`` (M18); ties by row_id."""
    v = C.eligible(venues, ["price_nis", "rating"]).select("row_id", "lat", "lng", "rating", "price_nis")
    near = [F.col("distance_km"), F.col("row_id")]
    # venues at one place are equally far from any query: the first k by row_id are enough
    v = top_k_per_group(v, ["lat", "lng"], [F.col("row_id")], k).drop("rank").checkpoint()
    queries = queries.select("query_id", F.col("lat").alias("q_lat"), F.col("lng").alias("q_lng"), "persona", "max_dist_km").checkpoint()
    # queries of one place and radius are answered once
    alike = ["q_lat", "q_lng", "max_dist_km"]
    asked = queries.select(*alike).distinct().withColumn("_q", F.monotonically_increasing_id()).checkpoint()
    # where k venues lie within a part of the radius, none beyond it is among the nearest k:
    # the others go on with a wider one
    q = asked.select("_q", F.col("q_lat").alias("lat"), F.col("q_lng").alias("lng"), "max_dist_km")
    parts: list[DataFrame] = []
    for share in BASELINE_SHARES:
        found = top_k_per_group(radius_join(q.withColumn("max_dist_km", F.col("max_dist_km") * share), v), "_q", near, k).checkpoint()
        full = found.filter(F.col("rank") == k).select("_q").checkpoint()
        parts.append(found if share == 1 else found.join(apart(full), "_q", "left_semi"))
        q = q.join(apart(full), "_q", "left_anti").checkpoint()
        if q.isEmpty():
            break
    lists = functools.reduce(DataFrame.unionByName, parts).drop("rank", "q_lat", "q_lng", "max_dist_km")
    every = queries.join(apart(lists.join(apart(asked), "_q").drop("_q")), alike)
    return top_k_per_group(every, "query_id", near, k).drop("max_dist_km").withColumn("baseline_score", persona_score("persona"))


def q_baseline_distance(spark, sf):
    out = baseline_distance(common.clicks(spark, sf), common.venues(spark, sf))
    return out.select("query_id", F.col("rank").cast("bigint").alias("rank"), "row_id", r6("distance_km"),
                      r6("baseline_score"))


def baseline_vs_model(queries: DataFrame, venues: DataFrame, model: K.CentroidModel) -> DataFrame:
    """Mean top-10 score per persona: distance baseline vs model ranking."""
    b = (baseline_distance(queries, venues).groupBy("persona")
         .agg(F.avg("baseline_score").alias("baseline_top10_score")))
    m = predict(queries, venues, model).groupBy("persona").agg(F.avg("score").alias("model_top10_score"))
    return b.join(m, "persona", "full")


def q_baseline_vs_model(spark, sf):
    model, _ = venue_model(spark, sf)
    out = baseline_vs_model(common.clicks(spark, sf), common.venues(spark, sf), model)
    return out.select("persona", r6("baseline_top10_score"), r6("model_top10_score"))


def baseline_vs_model_split(spark: SparkSession, split: DataFrame, model: K.CentroidModel, lat: float = DEFAULT_POINT[0],
                            lng: float = DEFAULT_POINT[1]) -> DataFrame:
    """The comparison as the training run makes it: per persona, from one
    point, over the test rows only and up to the farthest of them, with the
    model fitted on the training rows."""
    test = split.filter(F.col("split") == "test").checkpoint()
    far = test.agg(F.max(haversine_km(F.lit(lat), F.lit(lng), "lat", "lng"))).first()[0] or 0.0
    queries = spark.createDataFrame([(i, lat, lng, p, float(far)) for i, p in enumerate(PERSONA_WEIGHTS)],
                                    "query_id long, lat double, lng double, persona string, max_dist_km double")
    return baseline_vs_model(queries, test, model)


def q_baseline_vs_model_split(spark, sf):
    model, split = venue_model(spark, sf)
    out = baseline_vs_model_split(spark, split, model)
    return out.select("persona", r6("baseline_top10_score"), r6("model_top10_score"))


# ---------------------------------------------------------------- SQL side

def _split_sql(table: str, id_col: str) -> str:
    return f"{unit_hash_sql(id_col, SEED)} < {1.0 - TEST_FRACTION!r}"


def kmeans_ctes(points: str, id_col: str, zs: list[str], ks: list[int], prefix: str) -> str:
    """CTEs {prefix}s0.. (the k-means++ start), {prefix}steps (Lloyd steps of
    every k until its centres rest) and {prefix}fit (k, j, c0..)."""
    p, top = prefix, max(ks)
    at = ", ".join(f"{z} AS c{i}" for i, z in enumerate(zs))
    seeds = [f"{p}s0 AS (SELECT {at} FROM {points} ORDER BY {hash32_sql(id_col, f'{SEED}:0')}, {id_col} LIMIT 1)"]
    for j in range(1, top):
        gaps = [" + ".join(f"({z} - s{m}.c{i}) * ({z} - s{m}.c{i})" for i, z in enumerate(zs)) for m in range(j)]
        gap = f"least({', '.join(gaps)})" if j > 1 else gaps[0]
        seeds.append(f"""{p}s{j} AS MATERIALIZED (SELECT {at} FROM (SELECT {points}.*, {gap} AS gap FROM {points}, {', '.join(f'{p}s{m} s{m}' for m in range(j))}) t
   WHERE gap > 0 ORDER BY -ln(({hash32_sql(id_col, f'{SEED}:{j}')} + 1) / 4294967297.0E0) / gap, {id_col} LIMIT 1)""")
    start = " UNION ALL ".join(f"SELECT 0 AS it, {k} AS k, {j} AS j, *, 1.0E0 AS moved FROM {p}s{j}" for k in ks for j in range(k))
    cs = [f"c{i}" for i in range(len(zs))]
    dist = " + ".join(f"(p.{z} - l.{c}) * (p.{z} - l.{c})" for z, c in zip(zs, cs))
    means = ", ".join(f"coalesce(avg(t.{z}), any_value(l.{c})) AS n{c}" for z, c in zip(zs, cs))
    gone = "greatest(" + ", ".join(f"abs(n{c} - {c})" for c in cs) + ")" if len(cs) > 1 else f"abs(n{cs[0]} - {cs[0]})"
    return ",\n".join(seeds) + f""",
{p}steps AS (SELECT * FROM (WITH RECURSIVE r(it, k, j, {', '.join(cs)}, moved) AS (
  SELECT * FROM ({start}) z
  UNION ALL
  SELECT it + 1, k, j, {', '.join('n' + c for c in cs)}, max({gone}) OVER (PARTITION BY k) FROM (
    SELECT l.it, l.k, l.j, {', '.join('any_value(l.' + c + ') AS ' + c for c in cs)}, {means}
    FROM r l LEFT JOIN (SELECT k, (m).j AS j, {', '.join(zs)} FROM (
        SELECT l.k, min({{'d': {dist}, 'j': l.j}}) AS m, {', '.join(f'any_value(p.{z}) AS {z}' for z in zs)}
        FROM {points} p, r l WHERE l.moved > {K.KMEANS_TOLERANCE!r} GROUP BY p.{id_col}, l.k) n) t ON t.k = l.k AND t.j = l.j
    WHERE l.moved > {K.KMEANS_TOLERANCE!r} AND l.it < {K.KMEANS_MAX_ITER} GROUP BY l.it, l.k, l.j) c)
  SELECT * FROM r)),
{p}fit AS MATERIALIZED (SELECT k, j, {', '.join(cs)} FROM {p}steps QUALIFY it = max(it) OVER (PARTITION BY k))"""


def model_ctes(src: str, cols: list[str], k: int, prefix: str, fill_zero: bool = True, ks: list[int] | None = None) -> str:
    """CTEs: {prefix}train, {prefix}st (scaler), {prefix}z (all src rows
    scaled), {prefix}tz (the train rows among them), those of ``kmeans_ctes``
    for ``ks``, {prefix}cen (the centres for k), {prefix}asg (row_id, cluster)
    and {prefix}orig (centres in original units)."""
    def v(c):
        return f"coalesce({c}, 0.0E0)" if fill_zero else c
    stats = ", ".join(f"avg({v(c)}) AS m{i}, CASE WHEN coalesce(stddev_pop({v(c)}), 0) = 0 THEN 1.0E0 "
                      f"ELSE stddev_pop({v(c)}) END AS s{i}" for i, c in enumerate(cols))
    zs = ", ".join(f"({v(c)} - st.m{i}) / st.s{i} AS z{i}" for i, c in enumerate(cols))
    dist = " + ".join(f"(z.z{i} - cen.c{i}) * (z.z{i} - cen.c{i})" for i in range(len(cols)))
    p = prefix
    orig = ", ".join(f"cen.c{i} * st.s{i} + st.m{i} AS {c}" for i, c in enumerate(cols))
    zn = [f"z{i}" for i in range(len(cols))]
    return f"""{p}train AS (SELECT * FROM {src} WHERE {_split_sql(src, 'row_id')}),
{p}st AS (SELECT {stats} FROM {p}train),
{p}z AS MATERIALIZED (SELECT s.*, {zs} FROM {src} s, {p}st st),
{p}tz AS MATERIALIZED (SELECT row_id, {', '.join(zn)} FROM {p}z WHERE {_split_sql(src, 'row_id')}),
{kmeans_ctes(f'{p}tz', 'row_id', zn, ks or [k], p)},
{p}cen AS (SELECT * FROM {p}fit WHERE k = {k}),
{p}orig AS (SELECT cen.j AS cluster, {orig} FROM {p}cen cen, {p}st st),
{p}asg AS (SELECT row_id, j AS cluster FROM (SELECT z.row_id, cen.j,
   row_number() OVER (PARTITION BY z.row_id ORDER BY {dist}, cen.j) AS rn FROM {p}z z, {p}cen cen) t WHERE rn = 1)"""


def labels_ctes(th_src: str, prefix: str, area: bool = False) -> str:
    """CTEs {prefix}cents (the model's centres) and {prefix}lab (cluster, label)."""
    p = prefix
    area_sel = ", lat" if area else ""
    area_lbl = (" || ' — ' || CASE WHEN lat >= 32.84 THEN 'Krayot' WHEN lat >= 32.78 THEN 'Haifa' ELSE 'Carmel' END"
                if area else "")
    return f"""{p}th AS (SELECT quantile_cont(price_nis, 0.33) AS p33, quantile_cont(price_nis, 0.67) AS p67,
   quantile_cont(rating, 0.33) AS r33, quantile_cont(rating, 0.67) AS r67 FROM {th_src}),
{p}cents AS (SELECT cluster, price_nis, rating{area_sel} FROM {p}orig),
{p}base AS (SELECT c.*, (CASE WHEN rating >= th.r67 THEN 'Good' WHEN rating >= th.r33 THEN 'Average' ELSE 'Below Average' END
   || ' & ' || CASE WHEN price_nis >= th.p67 THEN 'Expensive' WHEN price_nis >= th.p33 THEN 'Reasonable' ELSE 'Affordable' END{area_lbl}) AS base_label
   FROM {p}cents c, {p}th th),
{p}lab1 AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY base_label ORDER BY cluster) = 1 THEN base_label
   ELSE base_label || ' (₪' || CAST(CAST(round_even(price_nis, 0) AS BIGINT) AS VARCHAR) || ')' END AS label1 FROM {p}base),
{p}lab AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY label1 ORDER BY cluster) = 1 THEN label1
   ELSE label1 || ' #' || CAST(cluster AS VARCHAR) END AS label FROM {p}lab1)"""


ELIG = "elig AS (SELECT * FROM venues WHERE rating IS NOT NULL AND price_nis IS NOT NULL)"
HAIFA = (f"haifa AS (SELECT * FROM venues WHERE lat BETWEEN {HAIFA_BBOX['lat_min']} AND {HAIFA_BBOX['lat_max']} "
         f"AND lng BETWEEN {HAIFA_BBOX['lng_min']} AND {HAIFA_BBOX['lng_max']}), "
         "helig AS (SELECT * FROM haifa WHERE price_nis IS NOT NULL AND rating IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL)")
VENUE_MODEL = f"{ELIG},\n{model_ctes('elig', K.FEATURE_COLS, K_VENUES, 'v_')},\n{labels_ctes('venues', 'v_')}"
REGION_MODEL = (f"{HAIFA},\n{model_ctes('helig', K.REGION_FEATURE_COLS, K_VENUES, 'h_', fill_zero=False)},\n"
                f"{labels_ctes('haifa', 'h_', area=True)}")

SPLIT_SQL = with_views(f""", {ELIG}
SELECT row_id, CASE WHEN {_split_sql('elig', 'row_id')} THEN 'train' ELSE 'test' END AS split FROM elig""", "venues")

SPLIT_STRATIFIED_SQL = with_views(f""", {ELIG},
r AS (SELECT row_id, row_number() OVER (PARTITION BY city ORDER BY {hash32_sql('row_id', SEED)}, row_id) - 1 AS rk,
  count(*) OVER (PARTITION BY city) AS n FROM elig)
SELECT row_id, CASE WHEN rk >= n - ceil(n * {TEST_FRACTION!r}E0) THEN 'test' ELSE 'train' END AS split FROM r""", "venues")

_zsel = ", ".join(f"round(z{i}, 6) AS z_{c}" for i, c in enumerate(K.FEATURE_COLS))
SCALE_SQL = with_views(f""", {ELIG}, {model_ctes('elig', K.FEATURE_COLS, K_VENUES, 'v_')}
SELECT row_id, CASE WHEN {_split_sql('elig', 'row_id')} THEN 'train' ELSE 'test' END AS split, {_zsel} FROM v_z""", "venues")

_pdist = " + ".join(f"(p.{c} - c.c{i}) * (p.{c} - c.c{i})" for i, c in enumerate(PT_COLS))
PT_ASSIGN_CTE = f"""pcen AS (SELECT row_number() OVER (ORDER BY h, pt_id) - 1 AS j, f0 AS c0, f1 AS c1, f2 AS c2 FROM
   (SELECT *, {hash32_sql('pt_id', SEED)} AS h FROM cluster_points ORDER BY h, pt_id LIMIT {K_POINTS}) t),
passg AS (SELECT p.pt_id, p.f0, p.f1, p.f2, CAST(c.j AS INTEGER) AS cluster FROM cluster_points p JOIN
   (SELECT pt_id, j FROM (SELECT p.pt_id, c.j, row_number() OVER (PARTITION BY p.pt_id ORDER BY {_pdist}, c.j) AS rn
    FROM cluster_points p, pcen c) t WHERE rn = 1) c ON c.pt_id = p.pt_id)"""
CENTROID_ASSIGN_SQL = with_views(f", {PT_ASSIGN_CTE}\nSELECT pt_id, cluster FROM passg", "cluster_points")


def silhouette_sql(anchor_limit: int | None) -> str:
    anchors = "passg" if anchor_limit is None else (
        f"(SELECT * FROM passg ORDER BY {hash32_sql('pt_id', SEED)}, pt_id LIMIT {anchor_limit})")
    d = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in PT_COLS)
    tail = ("'exact' AS method" if anchor_limit is None else "round(stddev_samp(s) / sqrt(count(*)), 6) AS stderr")
    return f""", {PT_ASSIGN_CTE},
per AS (SELECT a.pt_id, a.cluster AS ca, b.cluster AS cb, sum(sqrt({d})) AS ds, count(*) AS n
   FROM {anchors} a, passg b GROUP BY a.pt_id, a.cluster, b.cluster),
agg AS (SELECT pt_id, max(CASE WHEN cb = ca THEN n END) AS n_own, max(CASE WHEN cb = ca THEN ds END) AS d_own,
   min(CASE WHEN cb <> ca THEN ds / n END) AS b FROM per GROUP BY pt_id),
sv AS (SELECT CASE WHEN n_own <= 1 OR b IS NULL THEN 0.0E0
   WHEN greatest(d_own / (n_own - 1), b) = 0 THEN 0.0E0
   ELSE (b - d_own / (n_own - 1)) / greatest(d_own / (n_own - 1), b) END AS s FROM agg)
SELECT round(avg(s), 6) AS silhouette, count(*) AS n_anchors, {tail} FROM sv"""


SIL_EXACT_SQL = with_views(silhouette_sql(None), "cluster_points")

_sq = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in PT_COLS)
SIL_SQUARED_SQL = with_views(f""", {PT_ASSIGN_CTE},
per AS (SELECT a.pt_id, a.cluster AS ca, b.cluster AS cb, sum({_sq}) AS ds, count(*) AS n
   FROM passg a, passg b GROUP BY a.pt_id, a.cluster, b.cluster),
agg AS (SELECT pt_id, max(CASE WHEN cb = ca THEN n END) AS n_own, max(CASE WHEN cb = ca THEN ds END) AS d_own,
   min(CASE WHEN cb <> ca THEN ds / n END) AS b FROM per GROUP BY pt_id),
sv AS (SELECT CASE WHEN n_own <= 1 OR b IS NULL THEN 0.0E0
   ELSE (b - d_own / (n_own - 1)) / greatest(d_own / (n_own - 1), b) END AS s FROM agg)
SELECT round(avg(s), 6) AS silhouette_sq FROM sv""", "cluster_points")
SIL_SAMPLED_SQL = with_views(silhouette_sql(500), "cluster_points")


def dbscan_sql(src: str, eps: float, min_samples: int) -> str:
    d = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in PT_COLS)
    return f"""nbr AS (SELECT a.pt_id AS a, b.pt_id AS b FROM {src} a JOIN {src} b
   ON abs(a.f0 - b.f0) <= {eps} AND abs(a.f1 - b.f1) <= {eps} WHERE {d} <= {eps * eps!r}),
deg AS (SELECT a AS pt_id, count(*) AS deg FROM nbr GROUP BY a),
core AS (SELECT pt_id FROM deg WHERE deg >= {min_samples}),
cedge AS (SELECT n.a, n.b FROM nbr n JOIN core c1 ON c1.pt_id = n.a JOIN core c2 ON c2.pt_id = n.b),
cc AS (SELECT * FROM (WITH RECURSIVE lp(node, comp) USING KEY (node) AS (
   SELECT pt_id, pt_id FROM core
   UNION
   SELECT e.a, min(l.comp) FROM lp l JOIN cedge e ON e.b = l.node GROUP BY e.a) SELECT * FROM lp)),
ccmin AS (SELECT node, min(comp) AS comp FROM cc GROUP BY node),
num AS (SELECT comp, CAST(row_number() OVER (ORDER BY comp) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT comp FROM ccmin) t),
corelab AS (SELECT c.node AS pt_id, n.cluster FROM ccmin c JOIN num n ON n.comp = c.comp),
borderlab AS (SELECT n.a AS pt_id, min(cl.cluster) AS cluster FROM nbr n JOIN corelab cl ON cl.pt_id = n.b
   WHERE n.a NOT IN (SELECT pt_id FROM core) GROUP BY n.a),
dblab AS (SELECT p.pt_id, CAST(coalesce(cl.cluster, bl.cluster, -1) AS INTEGER) AS cluster, cl.pt_id IS NOT NULL AS is_core
   FROM {src} p LEFT JOIN corelab cl ON cl.pt_id = p.pt_id LEFT JOIN borderlab bl ON bl.pt_id = p.pt_id)"""


DBSCAN_SQL = with_views(f", {dbscan_sql('cluster_points', 0.5, 5)}\nSELECT pt_id, cluster, is_core FROM dblab",
                        "cluster_points")

_pd = " + ".join(f"(t.{c} - c.{c}) * (t.{c} - c.{c})" for c in PT_COLS)
DBSCAN_ASSIGN_SQL = with_views(f""", ptrain AS (SELECT * FROM cluster_points WHERE {_split_sql('', 'pt_id')}),
ptest AS (SELECT * FROM cluster_points WHERE NOT ({_split_sql('', 'pt_id')})),
{dbscan_sql('ptrain', 0.5, 5)},
corepts AS (SELECT p.*, l.cluster FROM ptrain p JOIN dblab l ON l.pt_id = p.pt_id WHERE l.is_core)
SELECT pt_id, cluster FROM (SELECT t.pt_id, c.cluster, row_number() OVER (PARTITION BY t.pt_id ORDER BY {_pd}, c.pt_id) AS rn
  FROM ptest t, corepts c) x WHERE rn = 1""", "cluster_points")



def ward_sql(src: str, cols: list[str], k: int, id_col: str = "pt_id") -> str:
    """CTEs: wtree (lo, hi, height), the merges of greedy Ward over the distinct
    positions of ``src``, all reciprocal nearest pairs of a round at once, and
    wlab (id, cluster), the k clusters of the positions' smallest ids."""
    xs = [f"x{i}" for i in range(len(cols))]
    gap = " + ".join(f"(a.{x} - b.{x}) * (a.{x} - b.{x})" for x in xs)
    mean = ", ".join(f"CASE WHEN o.id IS NULL THEN c.{x} ELSE (c.n * c.{x} + o.n * o.{x}) / (c.n + o.n) END" for x in xs)
    return f"""wpos AS (SELECT min({id_col}) AS id, CAST(count(*) AS DOUBLE) AS n, {', '.join(f'{c} AS {x}' for c, x in zip(cols, xs))}
   FROM {src} GROUP BY {', '.join(cols)}),
wtree AS MATERIALIZED (SELECT lo, id AS hi, h AS height FROM (WITH RECURSIVE r(id, n, {', '.join(xs)}, lo, h) AS (
  SELECT id, n, {', '.join(xs)}, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE) FROM wpos
  UNION ALL
  (WITH c AS (SELECT * FROM r WHERE lo IS NULL),
   near AS (SELECT min({{'d': a.n * b.n / (a.n + b.n) * ({gap}),
        'mixed': least(a.id, b.id) % {W.MIX} * (greatest(a.id, b.id) % {W.MIX}) % {W.MIX} * {W.FACTOR} % {W.MIX}, 'lo': least(a.id, b.id), 'hi': greatest(a.id, b.id)}}) AS p
      FROM c a, c b WHERE a.id <> b.id GROUP BY a.id),
   both_ways AS (SELECT (p).lo AS lo, (p).hi AS hi, (p).d AS d FROM near GROUP BY p HAVING count(*) = 2)
   SELECT c.id, c.n + coalesce(o.n, 0), {mean}, g.lo, g.d
   FROM c LEFT JOIN both_ways l ON l.lo = c.id LEFT JOIN c o ON o.id = l.hi LEFT JOIN both_ways g ON g.hi = c.id
   WHERE (SELECT count(*) FROM c) > 1)) SELECT * FROM r) t WHERE lo IS NOT NULL),
wkept AS (SELECT lo, hi FROM (SELECT *, row_number() OVER (ORDER BY height DESC, lo DESC, hi DESC) AS rn FROM wtree) t WHERE rn >= {k}),
wroot AS (SELECT * FROM (WITH RECURSIVE u(id, root) AS (
  SELECT id, id FROM wpos WHERE id NOT IN (SELECT hi FROM wkept)
  UNION ALL SELECT e.hi, u.root FROM u JOIN wkept e ON e.lo = u.id) SELECT * FROM u) t),
wlab AS (SELECT id, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster FROM wroot)"""


_ward = f"ptrain AS (SELECT * FROM cluster_points WHERE {_split_sql('', 'pt_id')}),\n{ward_sql('ptrain', PT_COLS, K_POINTS)}"
WARD_CLUSTER_SQL = with_views(f""", {_ward}
SELECT p.pt_id, l.cluster FROM ptrain p JOIN wpos w ON w.x0 = p.f0 AND w.x1 = p.f1 AND w.x2 = p.f2 JOIN wlab l ON l.id = w.id""",
                              "cluster_points")
WARD_TREE_SQL = with_views(f", {_ward}\nSELECT lo, hi, round(height, 6) AS height FROM wtree", "cluster_points")

WARD_ASSIGN_SQL = with_views(f""", {PT_ASSIGN_CTE},
ptrain AS (SELECT * FROM passg WHERE {_split_sql('', 'pt_id')}),
ptest AS (SELECT * FROM passg WHERE NOT ({_split_sql('', 'pt_id')}))
SELECT pt_id, nn_id, cluster FROM (SELECT t.pt_id, c.pt_id AS nn_id, c.cluster,
  row_number() OVER (PARTITION BY t.pt_id ORDER BY {_pd}, c.pt_id) AS rn FROM ptest t, ptrain c) x WHERE rn = 1""",
                             "cluster_points")

KMEANS_ASSIGN_SQL = with_views(f""", {ELIG}, {model_ctes('elig', K.FEATURE_COLS, K_VENUES, 'v_')}
SELECT z.row_id, CASE WHEN {_split_sql('z', 'z.row_id')} THEN 'train' ELSE 'test' END AS split, CAST(a.cluster AS INTEGER) AS cluster
FROM v_z z JOIN v_asg a ON a.row_id = z.row_id""", "venues")


SWEEP_KS = list(range(3, 9))
ANCHORS = 10_000


def scores_ctes(rows: str, dims: int, prefix: str) -> str:
    """CTE {prefix}score (k, silhouette, anchors, stderr) of ``rows`` (row_id, k, cluster, z0..), as sampled."""
    d = " + ".join(f"(a.z{i} - b.z{i}) * (a.z{i} - b.z{i})" for i in range(dims))
    p = prefix
    return f"""{p}anchor AS MATERIALIZED (SELECT row_id FROM (SELECT DISTINCT row_id FROM {rows}) u ORDER BY {hash32_sql('row_id', SEED)}, row_id LIMIT {ANCHORS}),
{p}flat AS MATERIALIZED (SELECT row_id, {', '.join(f'any_value(z{i}) AS z{i}' for i in range(dims))}, list(cluster ORDER BY k) AS cl, list(k ORDER BY k) AS ks FROM {rows} GROUP BY row_id),
{p}pair AS (SELECT a.row_id, a.cl AS own, a.ks, b.cl AS other, sqrt({d}) AS dist FROM {p}flat a, {p}flat b WHERE a.row_id IN (FROM {p}anchor)),
{p}per AS (SELECT row_id, own, ks, other, sum(dist) AS ds, count(*) AS n FROM {p}pair GROUP BY ALL),
{p}un AS (SELECT row_id, unnest(ks) AS k, unnest(own) AS own, unnest(other) AS other, ds, n FROM {p}per),
{p}sums AS (SELECT row_id, k, own, other, sum(ds) AS ds, sum(n) AS n FROM {p}un GROUP BY ALL),
{p}agg AS (SELECT row_id, k, max(CASE WHEN other = own THEN n END) AS n_own, max(CASE WHEN other = own THEN ds END) AS d_own,
   min(CASE WHEN other <> own THEN ds / n END) AS b FROM {p}sums GROUP BY row_id, k),
{p}sv AS (SELECT k, CASE WHEN n_own <= 1 OR b IS NULL THEN 0.0E0 WHEN greatest(d_own / (n_own - 1), b) = 0 THEN 0.0E0
   ELSE (b - d_own / (n_own - 1)) / greatest(d_own / (n_own - 1), b) END AS s FROM {p}agg),
{p}score AS MATERIALIZED (SELECT k, avg(s) AS silhouette, count(*) AS anchors, stddev_samp(s) / sqrt(count(*)) AS stderr FROM {p}sv GROUP BY k)"""


def sweep_ctes(src: str, cols: list[str], prefix: str, fill_zero: bool = True) -> str:
    """CTEs {prefix}lab (row_id, k, cluster, z0.. of the train rows) and {prefix}score for all k of the sweep."""
    p, dims = prefix, len(cols)
    dist = " + ".join(f"(z.z{i} - f.c{i}) * (z.z{i} - f.c{i})" for i in range(dims))
    return f"""{model_ctes(src, cols, SWEEP_KS[0], p, fill_zero, SWEEP_KS)},
{p}all AS MATERIALIZED (SELECT z.row_id, f.k, (min({{'d': {dist}, 'j': f.j}})).j AS cluster, {', '.join(f'any_value(z.z{i}) AS z{i}' for i in range(dims))}
   FROM {p}z z, {p}fit f GROUP BY z.row_id, f.k),
{p}lab AS (SELECT * FROM {p}all WHERE {_split_sql('', 'row_id')}),
{scores_ctes(f'{p}lab', dims, p)}"""


K_SWEEP_SQL = with_views(f""", {ELIG}, {sweep_ctes('elig', K.FEATURE_COLS, 'v_')}
SELECT CAST(k AS INTEGER) AS k, round(silhouette, 6) AS silhouette, 'sampled' AS silhouette_method, anchors AS silhouette_anchors,
  round(stderr, 6) AS silhouette_stderr, k = (SELECT k FROM v_score ORDER BY silhouette DESC, k LIMIT 1) AS best FROM v_score""", "venues")

REGION_MODEL_SQL = with_views(f""", {HAIFA}, {sweep_ctes('helig', K.REGION_FEATURE_COLS, 'h_', fill_zero=False)},
best AS MATERIALIZED (SELECT k FROM h_score ORDER BY silhouette DESC, k LIMIT 1),
tlab AS (SELECT * FROM h_all WHERE NOT ({_split_sql('', 'row_id')}) AND k = (SELECT k FROM best)),
{scores_ctes('tlab', len(K.REGION_FEATURE_COLS), 't_')}
SELECT 'KMeans-Haifa' AS algorithm, CAST(a.k AS INTEGER) AS k, round(a.silhouette, 6) AS train_silhouette, 'sampled' AS train_silhouette_method,
  a.anchors AS train_silhouette_anchors, round(a.stderr, 6) AS train_silhouette_stderr, round(b.silhouette, 6) AS test_silhouette,
  'sampled' AS test_silhouette_method, b.anchors AS test_silhouette_anchors, round(b.stderr, 6) AS test_silhouette_stderr
FROM h_score a, t_score b WHERE a.k = (SELECT k FROM best)""", "venues")

CLUSTER_LABELS_SQL = with_views(f""", {VENUE_MODEL}
SELECT CAST(cluster AS INTEGER) AS cluster, label, round(price_nis, 6) AS price_nis, round(rating, 6) AS rating FROM v_lab""",
                                "venues")

REGION_LABELS_SQL = with_views(f""", {REGION_MODEL}
SELECT CAST(cluster AS INTEGER) AS cluster, label, round(price_nis, 6) AS price_nis, round(rating, 6) AS rating,
  round(lat, 6) AS lat FROM h_lab""", "venues")

CLUSTER_COUNTS_SQL = with_views(f""", {VENUE_MODEL}
SELECT l.label, count(*) AS venues FROM v_asg a JOIN v_lab l ON l.cluster = a.cluster GROUP BY l.label""", "venues")

LABEL_ORDER_SQL = with_views(f""", {VENUE_MODEL}
SELECT label, CASE WHEN label LIKE '%Good%' THEN 0 WHEN label LIKE '%Average%' THEN 1 ELSE 2 END AS order_quality,
  CASE WHEN label LIKE '%Affordable%' THEN 0 WHEN label LIKE '%Reasonable%' THEN 1 ELSE 2 END AS order_price FROM v_lab""",
                             "venues")


def _predict_sql(model: str, venues_src: str, asg: str, lab: str, limit_label: bool = False) -> str:
    ranked_filter = f"WHERE label = (SELECT label FROM {lab} ORDER BY cluster LIMIT 1)" if limit_label else ""
    return with_views(f""", {model},
pairs AS ({pairs_sql(venues=venues_src)}),
scored AS (SELECT p.*, a.cluster, l.label, {score_sql('p.persona', 'p.rating', 'p.price_nis', 'p.distance_km')} AS score
   FROM pairs p JOIN {asg} a ON a.row_id = p.row_id LEFT JOIN {lab} l ON l.cluster = a.cluster {ranked_filter}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id) AS rank FROM scored)
SELECT query_id, rank, row_id, round(distance_km, 2) AS distance_km, round(score, 2) AS score,
  CAST(cluster AS INTEGER) AS cluster, label FROM ranked WHERE rank <= 10""", "venues", "clicks")


PREDICT_SQL = _predict_sql(VENUE_MODEL, "elig", "v_asg", "v_lab")
PREDICT_REGION_SQL = _predict_sql(REGION_MODEL, "helig", "h_asg", "h_lab")
FILTER_LABEL_SQL = _predict_sql(VENUE_MODEL, "elig", "v_asg", "v_lab", limit_label=True).replace(
    "SELECT query_id, rank, row_id, round(distance_km, 2) AS distance_km, round(score, 2) AS score,\n  CAST(cluster AS INTEGER) AS cluster, label",
    "SELECT query_id, rank, row_id, round(score, 2) AS score, label")

PERSONA_SCORE_SQL = with_views(f""", {ELIG},
d AS (SELECT row_id, rating, price_nis, {_DIST_DEFAULT_SQL} AS distance_km FROM elig),
p AS (SELECT * FROM d, (VALUES ('student'), ('quality')) t(persona))
SELECT row_id, persona, round({score_sql('persona', 'rating', 'price_nis', 'distance_km')}, 6) AS score FROM p""", "venues")

PERSONA_ELIGIBLE_SQL = with_views(f""", pairs AS ({pairs_sql()}),
scored AS (SELECT *, {score_sql('persona', 'rating', 'price_nis', 'distance_km')} AS score FROM pairs
   WHERE CASE persona WHEN 'student' THEN rating >= 4.0 AND price_nis <= 52.0 WHEN 'quality' THEN rating >= 4.8 ELSE rating >= 4.0 AND price_nis <= 52.0 END),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id) AS rank FROM scored)
SELECT query_id, rank, row_id, round(score, 2) AS score FROM ranked WHERE rank <= 10""", "venues", "clicks")

_BASELINE_CTE = f"""pairs AS ({pairs_sql()}),
bl AS (SELECT *, {score_sql('persona', 'rating', 'price_nis', 'distance_km')} AS baseline_score,
   row_number() OVER (PARTITION BY query_id ORDER BY distance_km, row_id) AS rank FROM pairs),
bl10 AS (SELECT * FROM bl WHERE rank <= 10)"""
BASELINE_SQL = with_views(f""", {_BASELINE_CTE}
SELECT query_id, rank, row_id, round(distance_km, 6) AS distance_km, round(baseline_score, 6) AS baseline_score FROM bl10""",
                          "venues", "clicks")

BASELINE_VS_MODEL_SQL = with_views(f""", {_BASELINE_CTE}, {VENUE_MODEL},
mscored AS (SELECT p.*, {score_sql('p.persona', 'p.rating', 'p.price_nis', 'p.distance_km')} AS score FROM pairs p
   JOIN v_asg a ON a.row_id = p.row_id),
m10 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id) AS rk FROM mscored) t WHERE rk <= 10),
b AS (SELECT persona, avg(baseline_score) AS baseline_top10_score FROM bl10 GROUP BY persona),
m AS (SELECT persona, avg(score) AS model_top10_score FROM m10 GROUP BY persona)
SELECT coalesce(b.persona, m.persona) AS persona, round(b.baseline_top10_score, 6) AS baseline_top10_score,
  round(m.model_top10_score, 6) AS model_top10_score FROM b FULL JOIN m ON b.persona = m.persona""", "venues", "clicks")

BASELINE_SPLIT_SQL = with_views(f""", {ELIG},
t AS (SELECT *, {_DIST_DEFAULT_SQL} AS distance_km FROM elig WHERE NOT ({_split_sql('elig', 'row_id')})),
s AS (SELECT *, {score_sql('persona', 'rating', 'price_nis', 'distance_km')} AS score FROM t, (VALUES ('student'), ('quality')) p(persona)),
r AS (SELECT *, row_number() OVER (PARTITION BY persona ORDER BY distance_km, row_id) AS near,
  row_number() OVER (PARTITION BY persona ORDER BY score DESC, row_id) AS top FROM s)
SELECT persona, round(avg(CASE WHEN near <= 10 THEN score END), 6) AS baseline_top10_score,
  round(avg(CASE WHEN top <= 10 THEN score END), 6) AS model_top10_score FROM r GROUP BY persona""", "venues")

for _name, _fn, _sql in [
    ("split_train_test", q_split_train_test, SPLIT_SQL),
    ("split_stratified", q_split_stratified, SPLIT_STRATIFIED_SQL),
    ("standard_scale", q_standard_scale, SCALE_SQL),
    ("centroid_assign", q_centroid_assign, CENTROID_ASSIGN_SQL),
    ("kmeans_assign", q_kmeans_assign, KMEANS_ASSIGN_SQL),
    ("k_sweep", q_k_sweep, K_SWEEP_SQL),
    ("silhouette_exact", q_silhouette_exact, SIL_EXACT_SQL),
    ("silhouette_sampled", q_silhouette_sampled, SIL_SAMPLED_SQL),
    ("silhouette_squared", q_silhouette_squared, SIL_SQUARED_SQL),
    ("dbscan", q_dbscan, DBSCAN_SQL),
    ("dbscan_assign", q_dbscan_assign, DBSCAN_ASSIGN_SQL),
    ("ward_cluster", q_ward_cluster, WARD_CLUSTER_SQL),
    ("ward_tree", q_ward_tree, WARD_TREE_SQL),
    ("ward_micro", q_ward_micro, None),
    ("ward_assign", q_ward_assign, WARD_ASSIGN_SQL),
    ("compare_algorithms", q_compare_algorithms, None),
    ("cluster_labels", q_cluster_labels, CLUSTER_LABELS_SQL),
    ("region_model", q_region_model, REGION_MODEL_SQL),
    ("region_labels", q_region_labels, REGION_LABELS_SQL),
    ("predict", q_predict, PREDICT_SQL),
    ("predict_region", q_predict_region, PREDICT_REGION_SQL),
    ("cluster_counts", q_cluster_counts, CLUSTER_COUNTS_SQL),
    ("label_order", q_label_order, LABEL_ORDER_SQL),
    ("filter_cluster_label", q_filter_cluster_label, FILTER_LABEL_SQL),
    ("persona_score", q_persona_score, PERSONA_SCORE_SQL),
    ("persona_eligible", q_persona_eligible, PERSONA_ELIGIBLE_SQL),
    ("baseline_distance", q_baseline_distance, BASELINE_SQL),
    ("baseline_vs_model", q_baseline_vs_model, BASELINE_VS_MODEL_SQL),
    ("baseline_vs_model_split", q_baseline_vs_model_split, BASELINE_SPLIT_SQL),
]:
    add(_name, _fn, _sql)
