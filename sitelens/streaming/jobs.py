"""Structured Streaming jobs.

R1: a stream of map clicks is ranked against the static venue table. A click
delivered again is dropped by event-time state (its query_id is remembered for
``remember`` of event time). Ranking (row_number per click) is not allowed on
a plain stream, so each micro-batch runs the batch plan inside
``foreachBatch`` and overwrites its own version of the sink
(``run=ID/version=N``, the ID being that of the checkpoint): a replayed batch
after a failure rewrites the same rows. The sink is keyed by query_id: reading
it gives each query_id its first version, so a click that the state no longer
knows (after a start without the old checkpoint) doesn't get a second list
either. R2: landed API pages are flattened and
appended to a parquet sink with a checkpoint (exactly-once file sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.operators.ranking import recommend_on_grid, venue_grid
from sitelens.sources.io import places_flatten

CLICK_SCHEMA = T.StructType([
    T.StructField("query_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("lat", T.DoubleType()),
    T.StructField("lng", T.DoubleType()), T.StructField("persona", T.StringType()),
    T.StructField("max_dist_km", T.DoubleType())])
PAGE_FILE_SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("body", T.StringType())])


def start_recommend_stream(spark: SparkSession, clicks_dir: str, venues: DataFrame, sink_dir: str,
                           checkpoint_dir: str, k: int = 10, files_per_trigger: int = 1,
                           available_now: bool = True, cell_deg: float = 0.015, remember: str = "30 days"):
    """Start R1; returns the StreamingQuery. ``venues`` is the static clean
    table: it is gridded and checkpointed once, and every micro-batch probes
    that. ``cell_deg`` (degrees) is fixed for the run.

    ``remember`` is the event time for which a query_id is known; a click older
    than that against the newest one is late and dropped, so a replay of
    history in any order needs a span as long as the history. Clicks without a
    query_id share one list; a click without a time counts as of now."""
    grid = venue_grid(venues, cell_deg, k)
    stream = (spark.readStream.schema(CLICK_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(clicks_dir))
    timed = stream.withColumn("_at", F.coalesce(F.col("ts").cast("timestamp"), F.current_timestamp())).withWatermark("_at", remember)
    stream = timed.dropDuplicatesWithinWatermark(["query_id"]).drop("_at")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        out = recommend_on_grid(batch.checkpoint(), grid)
        out.write.mode("overwrite").parquet(f"{sink_dir}/run={run}/version={batch_id}")

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    return writer.start()


def start_places_stream(spark: SparkSession, pages_dir: str, sink_dir: str, checkpoint_dir: str,
                        files_per_trigger: int = 1, available_now: bool = True):
    """Start R2: JSON-lines page files (page_id, body) -> flattened places."""
    stream = (spark.readStream.schema(PAGE_FILE_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
              .json(pages_dir))
    flat = places_flatten(stream)
    writer = (flat.writeStream.format("parquet").option("path", sink_dir)
              .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    return writer.start()


def read_recommend_sink(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The list of every query_id: the rows of its first version."""
    rows = spark.read.parquet(sink_dir).withColumn("_at", F.struct("version", "run"))
    first = rows.groupBy(F.col("query_id").alias("_q")).agg(F.min("_at").alias("_first"))
    return rows.join(first, F.col("query_id").eqNullSafe(F.col("_q")) & (F.col("_at") == F.col("_first"))).drop("_q", "_at", "_first", "version", "run")
