"""Source/sink and streaming plans (S1-S7, R1, R2). Each writes into a fresh
folder under the shared checkpoint folder, runs to the end, and returns the
read-back table, which must equal its input (or the batch result)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.operators import cluster as K
from sitelens.operators.cloud import TRI, apply_transform
from sitelens.plans import common
from sitelens.plans.clouds import REPORT_SQL, TRANSFORM, TRANSFORM_SQL, _report
from sitelens.plans.models import VENUE_MODEL, model_venues, venue_labels, venue_model
from sitelens.operators.ranking import display_round
from sitelens.plans.recommend import RECOMMEND_TOPK_SQL
from sitelens.plans.registry import add
from sitelens.session import scratch_path
from sitelens.sources import io, meshfiles
from sitelens.sources.fixtures import with_views
from sitelens.streaming import jobs


def q_venue_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "venues-csv")
    io.write_csv(common.venues_raw(spark, sf), path)
    return io.read_venues_csv(spark, path)


VENUE_SCAN_SQL = with_views("SELECT * FROM venues_raw", "venues_raw")


def q_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "clean-csv")
    io.write_csv(common.venues(spark, sf), path)
    return io.read_venues_csv(spark, path, io.VENUE_CLEAN_SCHEMA)


CSV_ROUNDTRIP_SQL = with_views("SELECT * FROM venues", "venues")


def q_deviation_report_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "report-csv")
    io.write_csv(_report(spark, sf).select("pt_id", "x", "y", "z", "deviation_m", "alert"), path)
    df = io.read_deviation_report(spark, path, threshold=0.05)
    return df.select("pt_id", "x", "y", "z", F.round("deviation_m", 6).alias("deviation_m"), "alert")


REPORT_SCAN_SQL = REPORT_SQL.replace(
    "SELECT pt_id, x, y, z, round(deviation_m, 6) AS deviation_m, alert, round(r, 6) AS r, round(g, 6) AS g, b FROM rep",
    "SELECT pt_id, x, y, z, round(deviation_m, 6) AS deviation_m, alert FROM rep")


def q_cloud_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "cloud")
    io.write_table(common.cloud_target(spark, sf), path)
    return io.read_table(spark, path)


CLOUD_SCAN_SQL = with_views("SELECT * FROM cloud_target", "cloud_target")


def q_places_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return io.places_flatten(common.places_pages(spark, sf))


PLACES_SQL = with_views(f"""SELECT page_id, CAST(i AS INTEGER) AS pos,
  coalesce(j.places[i + 1].displayName.text, '{io.NO_NAME}') AS name,
  coalesce(j.places[i + 1].formattedAddress, '{io.NO_ADDRESS}') AS address,
  j.places[i + 1].location.latitude AS lat, j.places[i + 1].location.longitude AS lng,
  j.places[i + 1].rating AS rating, CAST(coalesce(j.places[i + 1].userRatingCount, 0) AS BIGINT) AS raters,
  j.nextPageToken AS next_page_token
FROM (SELECT page_id, from_json(body, '{{"places":[{{"displayName":{{"text":"VARCHAR"}},"formattedAddress":"VARCHAR","location":{{"latitude":"DOUBLE","longitude":"DOUBLE"}},"rating":"DOUBLE","userRatingCount":"BIGINT"}}],"nextPageToken":"VARCHAR"}}') AS j
      FROM places_pages) p, range(len(p.j.places)) r(i)""", "places_pages")


def q_model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted model with its labels, saved and loaded again."""
    venues = model_venues(spark, sf)
    model, split = fitted = venue_model(spark, sf, venues)
    model.info["labels"] = {str(r["cluster"]): r["label"] for r in venue_labels(spark, sf, fitted, venues).collect()}
    path = scratch_path(spark, "model")
    model.save(spark, path)
    loaded = K.CentroidModel.load(spark, path)
    names = F.create_map(*[F.lit(x) for pair in loaded.info["labels"].items() for x in pair])
    return loaded.predict(split).select("row_id", F.col("cluster").cast("int").alias("cluster"),
                                        names[F.col("cluster").cast("string")].alias("label"))


MODEL_ROUNDTRIP_SQL = with_views(f""", {VENUE_MODEL}
SELECT a.row_id, CAST(a.cluster AS INTEGER) AS cluster, l.label FROM v_asg a JOIN v_lab l ON l.cluster = a.cluster""", "venues")


def q_transform_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "transform")
    io.save_transform(spark, TRANSFORM, path)
    m = io.load_transform(spark, path)
    t = apply_transform(common.cloud_source(spark, sf), m)
    return t.select("pt_id", *[F.round(a, 6).alias(a) for a in "xyz"])


def q_ply_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The scan written as PLY files and read back in byte ranges."""
    path = scratch_path(spark, "ply")
    meshfiles.write_ply(common.cloud_source(spark, sf).select("pt_id", "x", "y", "z").repartition(4), path)
    return meshfiles.read_ply(spark, path, range_bytes=1 << 16).select("pt_id", *[F.round(a, 6).alias(a) for a in "xyz"])


PLY_SQL = with_views("SELECT pt_id, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM cloud_source", "cloud_source")


def q_obj_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The mesh written as OBJ files and read back."""
    path = scratch_path(spark, "obj")
    meshfiles.write_obj(common.mesh_triangles(spark, sf).repartition(4, "tri_id"), path)
    return meshfiles.read_obj(spark, path, range_bytes=1 << 18).select(*[F.round(c, 6).alias(c) for c in TRI])


OBJ_SQL = with_views("SELECT " + ", ".join(f"round({c}, 6) AS {c}" for c in TRI) + " FROM mesh_triangles", "mesh_triangles")


def q_stream_recommend(spark: SparkSession, sf: str) -> DataFrame:
    """Replay the clicks as three files in time order through R1."""
    base = scratch_path(spark, "clicks-stream")
    clicks = common.clicks(spark, sf).select(*[f.name for f in jobs.CLICK_SCHEMA.fields])
    clicks.repartitionByRange(3, "ts", "query_id").write.mode("overwrite").parquet(f"{base}/in")
    q = jobs.start_recommend_stream(spark, f"{base}/in", common.venues(spark, sf), f"{base}/out", f"{base}/ckpt",
                                    remember="3650 days")
    q.awaitTermination()
    return display_round(jobs.read_recommend_sink(spark, f"{base}/out"))


def q_stream_places(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "places-stream")
    common.places_pages(spark, sf).repartition(3).write.mode("overwrite").json(f"{base}/in")
    q = jobs.start_places_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


for _name, _fn, _sql in [
    ("venue_scan", q_venue_scan, VENUE_SCAN_SQL),
    ("csv_roundtrip", q_csv_roundtrip, CSV_ROUNDTRIP_SQL),
    ("deviation_report_scan", q_deviation_report_scan, REPORT_SCAN_SQL),
    ("cloud_scan", q_cloud_scan, CLOUD_SCAN_SQL),
    ("places_flatten", q_places_flatten, PLACES_SQL),
    ("model_roundtrip", q_model_roundtrip, MODEL_ROUNDTRIP_SQL),
    ("transform_roundtrip", q_transform_roundtrip, TRANSFORM_SQL),
    ("ply_roundtrip", q_ply_roundtrip, PLY_SQL),
    ("obj_roundtrip", q_obj_roundtrip, OBJ_SQL),
    ("stream_recommend", q_stream_recommend, RECOMMEND_TOPK_SQL),
    ("stream_places", q_stream_places, PLACES_SQL),
]:
    add(_name, _fn, _sql)
