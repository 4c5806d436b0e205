"""Exploration plans over the venue table: cleaning steps, filters,
profiles, top lists and samples (tier 1), each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.geo import HAIFA_BBOX, haversine_km, haversine_sql, sub_area
from sitelens.functions.hashing import hash32_sql, unit_hash, unit_hash_sql
from sitelens.functions.scalar import PRICE_COLS, PRICE_LABELS, row_mean
from sitelens.operators import clean as C
from sitelens.operators import profile as P
from sitelens.operators.ranking import sample_rows as _sample_rows
from sitelens.operators.ranking import top_k
from sitelens.plans import common
from sitelens.plans.registry import add
from sitelens.sources.fixtures import with_views

PRICE_COL = "price_turkey_shawarma_pita"   # first product of the UI list
DEFAULT_POINT = (31.5, 34.9)               # training reference point
SIDEBAR = dict(cities=("NATION_1", "NATION_3", "NATION_5", "NATION_8", "NATION_13", "NATION_21"),
               price_range=(40.0, 50.0), min_rating=3.0, parking_only=True)


def r6(c: str) -> F.Column:
    return F.round(F.col(c), 6).alias(c)


def sql_r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


def _rated_default(df: DataFrame) -> DataFrame:
    """The UI's default slice: full price range of the product (null prices
    drop) and rating >= 1.0."""
    b = P.price_bounds(df, PRICE_COL).first()
    return C.filter_sidebar(df, PRICE_COL, price_range=(b["price_min"], b["price_max"]), min_rating=1.0)


RATED_DEFAULT_SQL = f"""rated AS (SELECT * FROM venues WHERE {PRICE_COL} BETWEEN
  (SELECT CAST(trunc(min({PRICE_COL})) AS INTEGER) FROM venues) AND (SELECT CAST(trunc(max({PRICE_COL})) AS INTEGER) FROM venues)
  AND rating IS NOT NULL AND rating >= 1.0)"""


# ---- cleaning steps ------------------------------------------------------

def q_coerce_numeric(spark: SparkSession, sf: str) -> DataFrame:
    raw = common.venues_raw(spark, sf)
    return C.coerce_numeric(raw).select("row_id", "rating", "reviews_count", *PRICE_COLS)


COERCE_SQL = with_views(
    "SELECT row_id, try_cast(rating AS DOUBLE) AS rating, try_cast(reviews_count AS DOUBLE) AS reviews_count, "
    + ", ".join(f"try_cast({c} AS DOUBLE) AS {c}" for c in PRICE_COLS) + " FROM venues_raw", "venues_raw")


def q_row_mean_price(spark: SparkSession, sf: str) -> DataFrame:
    raw = C.coerce_numeric(common.venues_raw(spark, sf))
    return raw.select("row_id", row_mean(PRICE_COLS).alias("price_mean"))


_ROW_MEAN = ("(" + " + ".join(f"coalesce(try_cast({c} AS DOUBLE), 0.0E0)" for c in PRICE_COLS) + ") / nullif("
             + " + ".join(f"(CASE WHEN try_cast({c} AS DOUBLE) IS NOT NULL THEN 1 ELSE 0 END)" for c in PRICE_COLS)
             + ", 0)")
ROW_MEAN_SQL = with_views(f"SELECT row_id, {_ROW_MEAN} AS price_mean FROM venues_raw", "venues_raw")


def q_dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    raw = common.venues_raw(spark, sf).select("row_id", "name", "latitude", "longitude")
    return C.dedup_keep_first(raw, ["name", "latitude", "longitude"])


DEDUP_SQL = with_views("""SELECT row_id, name, latitude, longitude FROM (
  SELECT row_id, name, latitude, longitude,
         row_number() OVER (PARTITION BY name, latitude, longitude ORDER BY row_id) AS rn FROM venues_raw) t
WHERE rn = 1""", "venues_raw")


def q_clean_venues(spark: SparkSession, sf: str) -> DataFrame:
    return common.venues(spark, sf)


CLEAN_SQL = with_views("SELECT * FROM venues", "venues")


def q_price_long(spark: SparkSession, sf: str) -> DataFrame:
    return C.price_long(common.venues(spark, sf), PRICE_LABELS)


PRICE_LONG_SQL = with_views(" UNION ALL ".join(
    f"SELECT row_id, '{lbl}' AS product, {col} AS price FROM venues" for lbl, col in PRICE_LABELS.items()), "venues")


def q_distance_from_point(spark: SparkSession, sf: str) -> DataFrame:
    v = common.venues(spark, sf)
    d = haversine_km(F.lit(DEFAULT_POINT[0]), F.lit(DEFAULT_POINT[1]), "lat", "lng")
    return v.select("row_id", F.round(d, 6).alias("distance_km"))


_DIST_DEFAULT = haversine_sql(f"{DEFAULT_POINT[0]!r}E0", f"{DEFAULT_POINT[1]!r}E0", "lat", "lng")
DISTANCE_SQL = with_views(f"SELECT row_id, round({_DIST_DEFAULT}, 6) AS distance_km FROM venues", "venues")


def q_build_features(spark: SparkSession, sf: str) -> DataFrame:
    v = common.venues(spark, sf).drop("price_nis", "ratings_count")
    f = C.build_features(v, *DEFAULT_POINT)
    return f.select("row_id", r6("price_nis"), "ratings_count", r6("distance_km"))


BUILD_FEATURES_SQL = with_views(f"""SELECT row_id,
  round({_ROW_MEAN.replace('try_cast(', '(').replace(' AS DOUBLE)', ')')}, 6) AS price_nis,
  CAST(coalesce(reviews_count, 0) AS INTEGER) AS ratings_count,
  round({_DIST_DEFAULT}, 6) AS distance_km FROM venues""", "venues")


def q_sub_area(spark: SparkSession, sf: str) -> DataFrame:
    v = C.bbox_filter(common.venues(spark, sf))
    return v.select("row_id", sub_area("lat").alias("sub_area"))


SUB_AREA_SQL = with_views(f"""SELECT row_id, CASE WHEN lat >= 32.84 THEN 'Krayot' WHEN lat >= 32.78 THEN 'Haifa' ELSE 'Carmel' END AS sub_area
FROM venues WHERE lat BETWEEN {HAIFA_BBOX['lat_min']} AND {HAIFA_BBOX['lat_max']}
  AND lng BETWEEN {HAIFA_BBOX['lng_min']} AND {HAIFA_BBOX['lng_max']}""", "venues")


# ---- filters -------------------------------------------------------------

def q_filter_sidebar(spark: SparkSession, sf: str) -> DataFrame:
    out = C.filter_sidebar(common.venues(spark, sf), PRICE_COL, **SIDEBAR)
    return out.select("row_id", "name", "city", "rating", F.col(PRICE_COL).alias("price"), "car_park_nearby")


_cities = ", ".join(f"'{c}'" for c in SIDEBAR["cities"])
FILTER_SIDEBAR_SQL = with_views(f"""SELECT row_id, name, city, rating, {PRICE_COL} AS price, car_park_nearby FROM venues
WHERE city IN ({_cities}) AND {PRICE_COL} BETWEEN {SIDEBAR['price_range'][0]} AND {SIDEBAR['price_range'][1]}
  AND rating IS NOT NULL AND rating >= {SIDEBAR['min_rating']} AND car_park_nearby = true""", "venues")


def q_bbox_filter(spark: SparkSession, sf: str) -> DataFrame:
    return C.bbox_filter(common.venues(spark, sf)).select("row_id", "lat", "lng", "city")


BBOX_SQL = with_views(f"""SELECT row_id, lat, lng, city FROM venues
WHERE lat BETWEEN {HAIFA_BBOX['lat_min']} AND {HAIFA_BBOX['lat_max']} AND lng BETWEEN {HAIFA_BBOX['lng_min']} AND {HAIFA_BBOX['lng_max']}""",
                      "venues")


# ---- aggregates ----------------------------------------------------------

def q_eda_metrics(spark: SparkSession, sf: str) -> DataFrame:
    m = P.eda_metrics(common.venues(spark, sf), PRICE_COL)
    return m.select("n_venues", "n_cities", r6("avg_price"), r6("median_price"), r6("avg_rating"),
                    "null_ratings", "estimated_prices", "unique_venues")


EDA_SQL = with_views(f"""SELECT count(*) AS n_venues, count(DISTINCT city) AS n_cities,
  round(avg({PRICE_COL}), 6) AS avg_price, round(quantile_cont({PRICE_COL}, 0.5), 6) AS median_price,
  round(avg(CASE WHEN {PRICE_COL} IS NOT NULL THEN rating END), 6) AS avg_rating,
  count(CASE WHEN rating IS NULL THEN 1 END) AS null_ratings,
  count(CASE WHEN price_source = 'estimated' THEN 1 END) AS estimated_prices,
  count(DISTINCT name) AS unique_venues FROM venues""", "venues")


def q_quality_counts(spark: SparkSession, sf: str) -> DataFrame:
    raw, clean = common.venues_raw(spark, sf), common.venues(spark, sf)
    return P.quality_counts(raw, clean, _rated_default(clean))


QUALITY_SQL = with_views(f""", {RATED_DEFAULT_SQL}
SELECT (SELECT count(*) FROM venues_raw) AS raw_rows, (SELECT count(*) FROM venues) AS clean_rows,
  (SELECT count(*) FROM rated) AS filtered_rows,
  (SELECT count(*) FROM venues WHERE rating IS NULL) AS null_ratings,
  (SELECT count(DISTINCT city) FROM venues) AS cities,
  (SELECT count(*) FROM venues WHERE price_source = 'estimated') AS estimated""", "venues")


def q_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return P.null_profile(common.venues(spark, sf))


_CLEAN_TYPES = {"row_id": "bigint", "lat": "double", "lng": "double", "city": "string", "name": "string",
                "rating": "double", "reviews_count": "double", **{c: "double" for c in PRICE_COLS},
                "price_nis": "double", "ratings_count": "int", "car_park_nearby": "boolean",
                "price_source": "string", "google_maps_url": "string"}
NULL_PROFILE_SQL = with_views(" UNION ALL ".join(
    f"SELECT {i} AS pos, '{c}' AS \"column\", '{_CLEAN_TYPES[c]}' AS dtype, count({c}) AS non_null, "
    f"count(*) - count({c}) AS nulls, concat(CAST(round((count(*) - count({c})) * 100.0E0 / count(*), 1) AS VARCHAR), '%') AS null_pct "
    f"FROM venues" for i, c in enumerate(C.CLEAN_COLUMNS)), "venues")


def q_city_list(spark: SparkSession, sf: str) -> DataFrame:
    return P.city_list(common.venues(spark, sf))


CITY_LIST_SQL = with_views("SELECT DISTINCT city FROM venues WHERE city IS NOT NULL ORDER BY city", "venues")


def q_price_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return P.price_bounds(common.venues(spark, sf), PRICE_COL)


PRICE_BOUNDS_SQL = with_views(f"""SELECT CAST(trunc(min({PRICE_COL})) AS INTEGER) AS price_min,
  CAST(trunc(max({PRICE_COL})) AS INTEGER) AS price_max FROM venues""", "venues")

_BASE = f"venues WHERE rating IS NOT NULL AND {PRICE_COL} IS NOT NULL"


def q_price_rating_corr(spark: SparkSession, sf: str) -> DataFrame:
    return P.price_rating_corr(common.venues(spark, sf), PRICE_COL).select("n", r6("pearson_r"))


CORR_SQL = with_views(f"SELECT count(*) AS n, round(corr({PRICE_COL}, rating), 6) AS pearson_r FROM {_BASE}", "venues")


def q_price_iqr(spark: SparkSession, sf: str) -> DataFrame:
    return P.price_quartiles(common.venues(spark, sf), PRICE_COL).select(r6("q25"), r6("q75"), r6("iqr"))


IQR_SQL = with_views(f"""SELECT round(quantile_cont({PRICE_COL}, 0.25), 6) AS q25, round(quantile_cont({PRICE_COL}, 0.75), 6) AS q75,
  round(quantile_cont({PRICE_COL}, 0.75) - quantile_cont({PRICE_COL}, 0.25), 6) AS iqr FROM {_BASE}""", "venues")


def q_city_price_spread(spark: SparkSession, sf: str) -> DataFrame:
    return P.city_price_spread(common.venues(spark, sf), PRICE_COL).select("n_cities", r6("spread"))


SPREAD_SQL = with_views(f"""SELECT count(*) AS n_cities, round(max(m) - min(m), 6) AS spread FROM
  (SELECT city, avg({PRICE_COL}) AS m FROM {_BASE} AND city IS NOT NULL GROUP BY city) t""", "venues")


def q_pct_in_iqr(spark: SparkSession, sf: str) -> DataFrame:
    return P.pct_in_iqr(common.venues(spark, sf), PRICE_COL).select(r6("pct_in_iqr"))


PCT_IQR_SQL = with_views(f""", q AS (SELECT quantile_cont({PRICE_COL}, 0.25) AS q25, quantile_cont({PRICE_COL}, 0.75) AS q75 FROM {_BASE})
SELECT round(avg(CASE WHEN {PRICE_COL} >= q.q25 AND {PRICE_COL} <= q.q75 THEN 1.0E0 ELSE 0.0E0 END) * 100, 6) AS pct_in_iqr
FROM {_BASE.replace('venues WHERE', 'venues, q WHERE')}""", "venues")


def q_trend_line(spark: SparkSession, sf: str) -> DataFrame:
    t = P.trend_line(common.venues(spark, sf), PRICE_COL)
    return t.select(F.col("i").cast("int").alias("i"), r6("slope"), r6("intercept"), r6("x"), r6("y"))


TREND_SQL = with_views(f""", fit AS (SELECT regr_slope(rating, {PRICE_COL}) AS slope, regr_intercept(rating, {PRICE_COL}) AS intercept,
  min({PRICE_COL}) AS lo, max({PRICE_COL}) AS hi FROM venues
  WHERE {PRICE_COL} IS NOT NULL AND rating IS NOT NULL AND city IS NOT NULL AND name IS NOT NULL),
pts AS (SELECT CAST(i AS INTEGER) AS i, slope, intercept,
  CASE WHEN i = 99 THEN hi ELSE i * ((hi - lo) / 99) + lo END AS x FROM fit, range(0, 100) r(i))
SELECT i, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(x, 6) AS x,
  round(slope * x + intercept, 6) AS y FROM pts""", "venues")


def q_price_histogram(spark: SparkSession, sf: str) -> DataFrame:
    h = P.histogram(common.venues(spark, sf), PRICE_COL, 30)
    return h.select("bin", r6("bin_lo"), r6("bin_hi"), "count")


def histogram_sql(table: str, col: str, bins: int) -> str:
    return f""", b AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {table} WHERE {col} IS NOT NULL),
c AS (SELECT CASE WHEN b.hi > b.lo THEN CAST(least(floor(({col} - b.lo) / ((b.hi - b.lo) / {bins})), {bins - 1}) AS INTEGER) ELSE 0 END AS bin,
  count(*) AS cnt FROM {table}, b WHERE {col} IS NOT NULL GROUP BY 1),
s AS (SELECT CAST(i AS INTEGER) AS bin FROM range(0, {bins}) r(i))
SELECT s.bin, round(b.lo + s.bin * ((b.hi - b.lo) / {bins}), 6) AS bin_lo,
  round(CASE WHEN s.bin = {bins - 1} THEN b.hi ELSE b.lo + (s.bin + 1) * ((b.hi - b.lo) / {bins}) END, 6) AS bin_hi,
  coalesce(c.cnt, 0) AS count FROM s CROSS JOIN b LEFT JOIN c ON c.bin = s.bin"""


HIST_SQL = with_views(histogram_sql("venues", PRICE_COL, 30), "venues")


def q_city_rating_top(spark: SparkSession, sf: str) -> DataFrame:
    return P.city_rating_top(common.venues(spark, sf)).select("city", r6("avg_rating"), "venues")


CITY_TOP_SQL = with_views("""SELECT city, round(avg(rating), 6) AS avg_rating, count(*) AS venues FROM venues
WHERE rating IS NOT NULL GROUP BY city HAVING count(*) >= 5 ORDER BY round(avg(rating), 9) DESC, city LIMIT 20""", "venues")


def q_city_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return P.city_centroids(common.venues(spark, sf)).select("city", r6("lat"), r6("lng"))


CENTROIDS_SQL = with_views("""SELECT city, round(avg(lat), 6) AS lat, round(avg(lng), 6) AS lng FROM venues
WHERE city IS NOT NULL GROUP BY city""", "venues")


def q_label_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    t = P.label_thresholds(common.venues(spark, sf))
    return t.select(*[r6(c) for c in t.columns])


THRESH_SQL = with_views("""SELECT round(quantile_cont(price_nis, 0.33), 6) AS price_33, round(quantile_cont(price_nis, 0.67), 6) AS price_67,
  round(quantile_cont(rating, 0.33), 6) AS rating_33, round(quantile_cont(rating, 0.67), 6) AS rating_67 FROM venues""", "venues")


# ---- top lists, samples, lookups ----------------------------------------

def q_top_rated(spark: SparkSession, sf: str) -> DataFrame:
    rated = _rated_default(common.venues(spark, sf))
    top = top_k(rated, [F.col("rating").desc(), F.col("row_id")], 50)
    return top.select(F.col("rank").cast("bigint").alias("rank"), "row_id", "name", "city", "rating",
                      F.col(PRICE_COL).alias("price"), "car_park_nearby", "google_maps_url")


TOP_RATED_SQL = with_views(f""", {RATED_DEFAULT_SQL}
SELECT row_number() OVER (ORDER BY rating DESC, row_id) AS rank, row_id, name, city, rating, {PRICE_COL} AS price,
  car_park_nearby, google_maps_url FROM rated ORDER BY rating DESC, row_id LIMIT 50""", "venues")


def q_map_markers(spark: SparkSession, sf: str) -> DataFrame:
    v = C.eligible(C.bbox_filter(common.venues(spark, sf)), ["price_nis", "rating", "lat", "lng"])
    top = top_k(v, [F.col("rating").desc(), F.col("row_id")], 400)
    return top.select(F.col("rank").cast("bigint").alias("rank"), "row_id", "name", "lat", "lng", "rating", "price_nis")


MARKERS_SQL = with_views(f"""SELECT row_number() OVER (ORDER BY rating DESC, row_id) AS rank, row_id, name, lat, lng, rating, price_nis
FROM venues WHERE lat BETWEEN {HAIFA_BBOX['lat_min']} AND {HAIFA_BBOX['lat_max']} AND lng BETWEEN {HAIFA_BBOX['lng_min']} AND {HAIFA_BBOX['lng_max']}
  AND price_nis IS NOT NULL AND rating IS NOT NULL ORDER BY rating DESC, row_id LIMIT 400""", "venues")


def q_sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    v = C.eligible(common.venues(spark, sf), ["price_nis", "rating"])
    return _sample_rows(v, 2000).select("row_id", "price_nis", "rating")


SAMPLE_SQL = with_views(f"""SELECT row_id, price_nis, rating FROM venues WHERE price_nis IS NOT NULL AND rating IS NOT NULL
ORDER BY {hash32_sql('row_id')}, row_id LIMIT 2000""", "venues")


def synthetic_queries(ids: DataFrame, id_col: str, seed: int = 42, bbox: dict = HAIFA_BBOX) -> DataFrame:
    """Uniform query points in a box, one per id (S8); repeatable for any layout."""
    u_lat, u_lng = unit_hash(id_col, f"{seed}:lat"), unit_hash(id_col, f"{seed}:lng")
    return ids.select(F.col(id_col).alias("query_id"),
                      (F.lit(bbox["lat_min"]) + F.lit(bbox["lat_max"] - bbox["lat_min"]) * u_lat).alias("lat"),
                      (F.lit(bbox["lng_min"]) + F.lit(bbox["lng_max"] - bbox["lng_min"]) * u_lng).alias("lng"))


def q_synthetic_queries(spark: SparkSession, sf: str) -> DataFrame:
    from sitelens.sources.fixtures import read_table
    ev = read_table(spark, sf, "events")
    return synthetic_queries(ev, "event_id").select("query_id", r6("lat"), r6("lng"))


_B = HAIFA_BBOX
SYNTH_SQL = f"""SELECT event_id AS query_id,
  round({_B['lat_min']!r}E0 + {_B['lat_max'] - _B['lat_min']!r}E0 * {unit_hash_sql('event_id', '42:lat')}, 6) AS lat,
  round({_B['lng_min']!r}E0 + {_B['lng_max'] - _B['lng_min']!r}E0 * {unit_hash_sql('event_id', '42:lng')}, 6) AS lng
FROM events"""


def city_query_point(users: DataFrame, venues: DataFrame) -> DataFrame:
    """User city -> query position at the city's venue centroid."""
    return users.join(P.city_centroids(venues), "city", "inner")


def q_city_query_point(spark: SparkSession, sf: str) -> DataFrame:
    from sitelens.sources.fixtures import read_table
    cust = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    users = cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(F.col("c_custkey").alias("user_id"), "city")
    return city_query_point(users, common.venues(spark, sf)).select("user_id", "city", r6("lat"), r6("lng"))


CITY_QUERY_SQL = with_views("""SELECT c.c_custkey AS user_id, n.n_name AS city, round(m.lat, 6) AS lat, round(m.lng, 6) AS lng
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN (SELECT city, avg(lat) AS lat, avg(lng) AS lng FROM venues WHERE city IS NOT NULL GROUP BY city) m ON m.city = n.n_name""", "venues")


def q_impute_group_median(spark: SparkSession, sf: str) -> DataFrame:
    v = common.venues(spark, sf).select("row_id", "city", "price_source", "price_nis")
    out = C.impute_group_median(v, "price_nis", ["city", "price_source"])
    return out.select("row_id", r6("price_nis"), "price_nis_imputed")


IMPUTE_SQL = with_views("""SELECT v.row_id, round(coalesce(v.price_nis, m.med), 6) AS price_nis,
  (v.price_nis IS NULL AND m.med IS NOT NULL) AS price_nis_imputed
FROM venues v LEFT JOIN (SELECT city, price_source, quantile_cont(price_nis, 0.5) AS med FROM venues GROUP BY city, price_source) m
  ON v.city = m.city AND v.price_source = m.price_source""", "venues")


for _name, _fn, _sql in [
    ("coerce_numeric", q_coerce_numeric, COERCE_SQL),
    ("row_mean_price", q_row_mean_price, ROW_MEAN_SQL),
    ("dedup_keep_first", q_dedup_keep_first, DEDUP_SQL),
    ("clean_venues", q_clean_venues, CLEAN_SQL),
    ("price_long", q_price_long, PRICE_LONG_SQL),
    ("distance_from_point", q_distance_from_point, DISTANCE_SQL),
    ("build_features", q_build_features, BUILD_FEATURES_SQL),
    ("sub_area", q_sub_area, SUB_AREA_SQL),
    ("filter_sidebar", q_filter_sidebar, FILTER_SIDEBAR_SQL),
    ("bbox_filter", q_bbox_filter, BBOX_SQL),
    ("eda_metrics", q_eda_metrics, EDA_SQL),
    ("quality_counts", q_quality_counts, QUALITY_SQL),
    ("null_profile", q_null_profile, NULL_PROFILE_SQL),
    ("city_list", q_city_list, CITY_LIST_SQL),
    ("price_bounds", q_price_bounds, PRICE_BOUNDS_SQL),
    ("price_rating_corr", q_price_rating_corr, CORR_SQL),
    ("price_iqr", q_price_iqr, IQR_SQL),
    ("city_price_spread", q_city_price_spread, SPREAD_SQL),
    ("pct_in_iqr", q_pct_in_iqr, PCT_IQR_SQL),
    ("trend_line", q_trend_line, TREND_SQL),
    ("price_histogram", q_price_histogram, HIST_SQL),
    ("city_rating_top", q_city_rating_top, CITY_TOP_SQL),
    ("city_centroids", q_city_centroids, CENTROIDS_SQL),
    ("label_thresholds", q_label_thresholds, THRESH_SQL),
    ("top_rated", q_top_rated, TOP_RATED_SQL),
    ("map_markers", q_map_markers, MARKERS_SQL),
    ("sample_rows", q_sample_rows, SAMPLE_SQL),
    ("synthetic_queries", q_synthetic_queries, SYNTH_SQL),
    ("city_query_point", q_city_query_point, CITY_QUERY_SQL),
    ("impute_group_median", q_impute_group_median, IMPUTE_SQL),
]:
    add(_name, _fn, _sql)
