"""Venue cleaning, projections and sidebar filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.geo import HAIFA_BBOX, haversine_km
from sitelens.functions.scalar import PRICE_COLS, row_mean, text_to_bool, to_double
from sitelens.operators.grouping import attach
from sitelens.operators.quantiles import group_quantiles


CLEAN_COLUMNS = [
    "row_id", "lat", "lng", "city", "name", "rating", "reviews_count", *PRICE_COLS,
    "price_nis", "ratings_count", "car_park_nearby", "price_source", "google_maps_url",
]


def rename_coordinates(df: DataFrame) -> DataFrame:
    """latitude/longitude -> lat/lng."""
    return df.withColumnsRenamed({"latitude": "lat", "longitude": "lng"})


def coerce_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Text columns to double, bad text -> null; absent columns are skipped."""
    cols = cols if cols is not None else ["rating", "reviews_count", *PRICE_COLS]
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: to_double(c) for c in present})


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order_col: str = "row_id") -> DataFrame:
    """Keep the row with the smallest ``order_col`` per key; null keys compare equal.

    Written as a grouped ``min`` over a struct led by ``order_col`` rather than
    a window: the aggregate combines map-side, so a key that holds a third of
    all rows shrinks to one row per map task before the shuffle instead of
    landing whole in one sorted window partition.
    """
    others = [c for c in df.columns if c not in keys]
    packed = F.min(F.struct(*[F.col(c) for c in [order_col] + [c for c in others if c != order_col]]))
    out = df.groupBy(*keys).agg(packed.alias("_first"))
    return out.select(*[F.col(k) for k in keys], "_first.*").select(*df.columns)


def clean_venues(raw: DataFrame) -> DataFrame:
    """The whole cleaning step (P1-P9): rename, coerce, price choice, counts,
    parking flag, drop missing coordinates, keep-first de-duplication. A review
    count beyond the integer range gives a null ratings_count."""
    df = rename_coordinates(raw)
    df = coerce_numeric(df)
    if "price_turkey_shawarma_pita" in df.columns:
        price = F.col("price_turkey_shawarma_pita")
    else:
        price = F.lit(None).cast("double")
    df = df.withColumns({
        "price_nis": price,
        "ratings_count": F.coalesce(F.col("reviews_count"), F.lit(0.0)).try_cast("int"),
        "car_park_nearby": text_to_bool("car_park_nearby"),
    })
    df = df.na.drop(subset=["lat", "lng"])
    df = dedup_keep_first(df, ["name", "lat", "lng"])
    cols = [c for c in CLEAN_COLUMNS if c in df.columns]
    cols += [c for c in df.columns if c not in cols]
    return df.select(*cols)


def price_long(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """All product prices in long form: one row per venue and product (P10)."""
    pairs = ", ".join(f"'{lbl}', `{col}`" for lbl, col in labels.items())
    return df.selectExpr("row_id", f"stack({len(labels)}, {pairs}) AS (product, price)")


def build_features(df: DataFrame, user_lat: float, user_lng: float) -> DataFrame:
    """Distance from one point plus filled price/ratings columns."""
    if "price_nis" not in df.columns:
        df = df.withColumn("price_nis", row_mean([c for c in PRICE_COLS if c in df.columns]))
    if "ratings_count" not in df.columns:
        df = df.withColumn("ratings_count", F.coalesce("reviews_count", F.lit(0.0)).try_cast("int"))
    return df.withColumn("distance_km", haversine_km(F.lit(float(user_lat)), F.lit(float(user_lng)),
                                                     "lat", "lng"))


def filter_sidebar(df: DataFrame, price_col: str, cities: Sequence[str] = (),
                   price_range: tuple[float, float] | None = None, min_rating: float = 1.0,
                   parking_only: bool = False) -> DataFrame:
    """Sidebar filters (F1-F4): city list (empty = all), inclusive price range
    (null prices drop), rated and at least ``min_rating``, parking only."""
    out = df
    if cities:
        out = out.filter(F.col("city").isin(list(cities)))
    if price_range is not None:
        out = out.filter(F.col(price_col).between(float(price_range[0]), float(price_range[1])))
    out = out.filter(F.col("rating").isNotNull() & (F.col("rating") >= float(min_rating)))
    if parking_only:
        out = out.filter(F.col("car_park_nearby") == F.lit(True))
    return out


def bbox_filter(df: DataFrame, bbox: dict[str, float] = HAIFA_BBOX,
                lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Inclusive box filter (F5); two ranges that reach parquet min/max stats."""
    return df.filter(F.col(lat).between(bbox["lat_min"], bbox["lat_max"])
                     & F.col(lng).between(bbox["lng_min"], bbox["lng_max"]))


def eligible(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with all the given feature columns present (F8)."""
    return df.na.drop(subset=list(cols))


def impute_group_median(df: DataFrame, col: str, group_cols: Sequence[str]) -> DataFrame:
    """Fill nulls in ``col`` with the median of its group, with a flag.

    The medians are one row per group, found over range-partitioned values
    (no task holds a whole group), and reach the rows by ``attach``, which
    doesn't shuffle the rows of large groups. Rows with a null group key stay as
    they are.
    """
    keys = [f"_g{i}" for i in range(len(group_cols))]
    med = group_quantiles(df, group_cols, col, {"_median": 0.5}).select(*[F.col(g).alias(k) for g, k in zip(group_cols, keys)], "_median")
    out = attach(df.withColumns({k: F.col(g) for k, g in zip(keys, group_cols)}), med.na.drop(subset=keys), keys, "left").drop(*keys)
    return out.withColumns({
        f"{col}_imputed": F.col(col).isNull() & F.col("_median").isNotNull(),
        col: F.coalesce(F.col(col), F.col("_median")),
    }).drop("_median")
