"""Cleaning edge cases, readers/writers and stream = batch."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tables import SF_SMALL
from sitelens.operators import clean as C
from sitelens.operators.cluster import CentroidModel
from sitelens.operators.ranking import recommend
from sitelens.plans import common
from sitelens.plans import io_plans
from sitelens.plans.recommend import recommend_topk
from sitelens.sources import io


def test_dedup_keep_first_null_keys(spark):
    df = spark.createDataFrame([(3, None, 1.0), (1, None, 1.0), (2, "a", 1.0), (5, "a", 1.0), (4, "a", 2.0)],
                               "row_id long, name string, lat double")
    out = sorted(r.row_id for r in C.dedup_keep_first(df, ["name", "lat"]).collect())
    assert out == [1, 2, 4]


def test_coerce_and_row_mean(spark):
    df = spark.createDataFrame([(1, " 4.5 ", "n/a", "NaN"), (2, None, "3", "1")], "row_id long, a string, b string, c string")
    out = {r.row_id: r for r in C.coerce_numeric(df, ["a", "b", "c"]).collect()}
    assert out[1].a == 4.5 and out[1].b is None and out[1].c is None
    from sitelens.functions.scalar import row_mean
    m = {r.row_id: r.m for r in C.coerce_numeric(df, ["a", "b", "c"]).select("row_id", row_mean(["a", "b", "c"]).alias("m")).collect()}
    assert m[1] == 4.5 and m[2] == 2.0
    allnull = spark.createDataFrame([(1, None, None)], "row_id long, a double, b double")
    assert allnull.select(row_mean(["a", "b"]).alias("m")).first().m is None


def test_clean_empty_in_empty_out(spark):
    empty = spark.createDataFrame([], io.VENUE_RAW_SCHEMA)
    out = C.clean_venues(empty)
    assert out.count() == 0 and "price_nis" in out.columns and "lat" in out.columns


def test_missing_csv_is_empty_with_schema(spark):
    df = io.read_venues_csv(spark, os.path.join(tempfile.mkdtemp(), "nope.csv"))
    assert df.count() == 0 and df.schema == io.VENUE_RAW_SCHEMA


def test_report_requires_columns(spark):
    path = os.path.join(tempfile.mkdtemp(), "bad")
    spark.createDataFrame([(1.0, 2.0)], "x double, y double").write.option("header", True).csv(path)
    with pytest.raises(ValueError):
        io.read_deviation_report(spark, path)


def test_model_load_missing_is_none(spark):
    assert CentroidModel.load(spark, os.path.join(tempfile.mkdtemp(), "none")) is None
    assert io.load_transform(spark, os.path.join(tempfile.mkdtemp(), "none")) is None


def test_stream_replay_equals_batch(spark):
    batch = recommend_topk(spark, SF_SMALL)
    stream = io_plans.q_stream_recommend(spark, SF_SMALL)
    cols = sorted(batch.columns)
    assert sorted(stream.columns) == cols
    assert batch.select(cols).exceptAll(stream.select(cols)).count() == 0
    assert stream.select(cols).exceptAll(batch.select(cols)).count() == 0


def test_a_click_gets_one_list_however_often_it_comes(spark, tmp_path):
    """The same click in two files, a late one, a restart on the same
    checkpoint, and a start without it: one list per query_id, as in batch."""
    from sitelens.streaming import jobs
    venues = common.venues(spark, SF_SMALL)
    clicks = common.clicks(spark, SF_SMALL).select(*[f.name for f in jobs.CLICK_SCHEMA.fields]).orderBy("ts", "query_id").limit(60).toPandas()
    schema = jobs.CLICK_SCHEMA
    files, sink = str(tmp_path / "in"), str(tmp_path / "out")

    def deliver(pdf):
        spark.createDataFrame(pdf, schema).coalesce(1).write.mode("append").parquet(files)

    def run(checkpoint):
        jobs.start_recommend_stream(spark, files, venues, sink, str(tmp_path / checkpoint), remember="3650 days").awaitTermination()

    deliver(clicks[20:45])
    deliver(clicks[30:50])              # again, and new ones
    run("ckpt")
    deliver(clicks[:25])                # late ones, and again
    deliver(clicks[40:])
    run("ckpt")                         # restart
    cols = ["query_id", "rank", "row_id"]
    want = sorted(map(tuple, recommend(spark.createDataFrame(clicks, schema), venues, cell_deg=0.015).select(*cols).collect()))
    got = sorted(map(tuple, jobs.read_recommend_sink(spark, sink).select(*cols).collect()))
    assert got == want and len(want) > 50
    run("other")                        # everything once more, the state lost
    assert sorted(map(tuple, jobs.read_recommend_sink(spark, sink).select(*cols).collect())) == want


def test_places_defaults(spark):
    out = io_plans.q_places_flatten(spark, SF_SMALL)
    second = out.filter(F.col("pos") == 1).collect()
    assert second and all(r.name == io.NO_NAME and r.raters == 0 and r.rating is None for r in second)
