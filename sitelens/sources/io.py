"""Readers and writers.

Schemas are fixed, never inferred: a text column that should hold numbers
stays text until ``coerce_numeric`` so bad values survive to be counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.functions.scalar import PRICE_COLS, to_double

_TEXT = T.StringType()
VENUE_RAW_SCHEMA = T.StructType(
    [T.StructField("row_id", T.LongType()), T.StructField("latitude", T.DoubleType()),
     T.StructField("longitude", T.DoubleType()), T.StructField("city", _TEXT), T.StructField("name", _TEXT),
     T.StructField("rating", _TEXT), T.StructField("reviews_count", _TEXT)]
    + [T.StructField(c, _TEXT) for c in PRICE_COLS]
    + [T.StructField("car_park_nearby", _TEXT), T.StructField("price_source", _TEXT),
       T.StructField("google_maps_url", _TEXT)])

VENUE_CLEAN_SCHEMA = T.StructType(
    [T.StructField("row_id", T.LongType()), T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType()),
     T.StructField("city", _TEXT), T.StructField("name", _TEXT), T.StructField("rating", T.DoubleType()),
     T.StructField("reviews_count", T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in PRICE_COLS]
    + [T.StructField("price_nis", T.DoubleType()), T.StructField("ratings_count", T.IntegerType()),
       T.StructField("car_park_nearby", T.BooleanType()), T.StructField("price_source", _TEXT),
       T.StructField("google_maps_url", _TEXT)])

REPORT_SCHEMA = T.StructType([T.StructField("pt_id", T.LongType()), T.StructField("x", T.DoubleType()),
                              T.StructField("y", T.DoubleType()), T.StructField("z", T.DoubleType()),
                              T.StructField("deviation_m", T.DoubleType()), T.StructField("alert", T.BooleanType())])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_venues_csv(spark: SparkSession, path: str, schema: T.StructType = VENUE_RAW_SCHEMA) -> DataFrame:
    """Venue CSV with header (S1), columns found by their header names.

    Everything is read as text (quotes doubled inside quoted fields) and then
    cast, so bad numbers become null. Columns of ``schema`` that the file
    lacks are null, and further columns of the file follow as text. Without a
    ``row_id`` in the file, one is added at ingest (monotonically increasing,
    file order within each task) and should be stored with the data so later
    runs keep it. A missing path gives an empty table with the schema."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    text = spark.read.option("header", True).option("escape", '"').option("mode", "PERMISSIVE").csv(path)
    out = []
    for f in schema.fields:
        if f.name not in text.columns:
            c = F.monotonically_increasing_id() if f.name == "row_id" else F.lit(None)
        elif f.dataType == T.DoubleType():
            c = to_double(f"`{f.name}`")
        else:
            c = F.col(f"`{f.name}`").try_cast(f.dataType)
        out.append(c.cast(f.dataType).alias(f.name))
    if "row_id" not in schema.fieldNames() and "row_id" not in text.columns:
        out.append(F.monotonically_increasing_id().alias("row_id"))
    return text.select(*out, *[F.col(f"`{c}`") for c in text.columns if c not in schema.fieldNames()])


def write_csv(df: DataFrame, path: str) -> None:
    """Header, no index, quotes doubled inside quoted fields (S3). Spark writes
    a folder of part files; a byte-order mark for spreadsheet tools is not
    written."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_deviation_report(spark: SparkSession, path: str, threshold: float | None = None) -> DataFrame:
    """Deviation report CSV with the required-column check (S4); with a
    threshold the alert flag is recomputed (P16)."""
    from sitelens.operators.cloud import check_report_columns

    header = spark.read.option("header", True).option("escape", '"').csv(path)
    check_report_columns(header)
    cols = [f for f in REPORT_SCHEMA.fields if f.name in header.columns]
    df = header.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in cols])
    if threshold is not None:
        df = df.withColumn("alert", F.col("deviation_m") > F.lit(float(threshold)))
    return df


def write_table(df: DataFrame, path: str) -> None:
    """Points, triangles and other tables as parquet."""
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_transform(spark: SparkSession, m, path: str) -> None:
    """A 4x4 transform as a one-row table."""
    rows = [([[float(v) for v in r] for r in m],)]
    spark.createDataFrame(rows, "matrix array<array<double>>").coalesce(1).write.mode("overwrite").parquet(path)


def load_transform(spark: SparkSession, path: str):
    if not _exists(spark, path):
        return None
    row = spark.read.parquet(path).first()
    return None if row is None else [list(r) for r in row["matrix"]]


# ---- S2: places API pages ------------------------------------------------

PLACE_SCHEMA = T.StructType([
    T.StructField("displayName", T.StructType([T.StructField("text", _TEXT)])),
    T.StructField("formattedAddress", _TEXT),
    T.StructField("location", T.StructType([T.StructField("latitude", T.DoubleType()),
                                            T.StructField("longitude", T.DoubleType())])),
    T.StructField("rating", T.DoubleType()),
    T.StructField("userRatingCount", T.LongType()),
])
PAGE_SCHEMA = T.StructType([T.StructField("places", T.ArrayType(PLACE_SCHEMA)),
                            T.StructField("nextPageToken", _TEXT)])

# Defaults for a place without a name or an address.
NO_NAME = "ללא שם"
NO_ADDRESS = "ללא כתובת"


def places_flatten(pages: DataFrame, body_col: str = "body", page_col: str = "page_id") -> DataFrame:
    """One row per place of every landed API page: name, address, lat, lng,
    rating, raters (S2). A missing rating stays null (double) instead of a
    text marker; a missing count is 0."""
    parsed = pages.select(page_col, F.from_json(F.col(body_col), PAGE_SCHEMA).alias("j"))
    ex = parsed.select(page_col, F.col("j.nextPageToken").alias("next_page_token"),
                       F.posexplode(F.col("j.places")).alias("pos", "p"))
    return ex.select(
        page_col, F.col("pos").cast("int").alias("pos"),
        F.coalesce(F.col("p.displayName.text"), F.lit(NO_NAME)).alias("name"),
        F.coalesce(F.col("p.formattedAddress"), F.lit(NO_ADDRESS)).alias("address"),
        F.col("p.location.latitude").alias("lat"), F.col("p.location.longitude").alias("lng"),
        F.col("p.rating").alias("rating"),
        F.coalesce(F.col("p.userRatingCount"), F.lit(0)).cast("bigint").alias("raters"),
        "next_page_token")
