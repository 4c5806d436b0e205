"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import math
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.session import ensure_checkpoint_dir, scratch_path

# At most this many keys are ever broadcast as "hot" (see attach_groups).
HOT_KEYS = 1000
# Up to this many ids (8 bytes each) are broadcast to select documents.
BROADCAST_IDS = 1_000_000
# Rows of an Arrow batch sent to Python: whole documents may be long.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Ship the package, name the checkpoint folder, keep Arrow batches small."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and
    read it back: lineage ends at a file every executor can read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(spark: SparkSession, amount: int, each: int) -> int:
    """Partitions for ``amount`` rows or bytes at about ``each``, at most as
    many as the session's shuffles have (an explicit number isn't coalesced)."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(8, -(-amount // each))))


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` over single record batches (a batch in, a batch out)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def binary_list(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def text_list(column: pa.Array) -> list[str]:
    return ["" if v is None else v for v in column.to_pylist()]


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps: its cleaner acts
    once the driver has collected the plans that made them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written with a number of its own for every row, and the name of
    that column. Rows with null, repeated or equal ids stay apart by it."""
    key = "_row"
    while key in df.columns:
        key += "_"
    return materialize(df.withColumn(key, F.monotonically_increasing_id()), name), key


def select_ids(docs: DataFrame, ids: DataFrame, how: str, on: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose ``on`` is (``left_semi``) or isn't
    (``left_anti``) in the one column of ``ids``, a written table of distinct
    values. Null equals null. Up to BROADCAST_IDS ids are broadcast and the
    texts stay where they are; more meet the texts in a sort-merge join."""
    (name,) = ids.columns
    side = ids.withColumnRenamed(name, "_picked")
    side = F.broadcast(side) if ids.count() <= BROADCAST_IDS else side.hint("merge")
    return docs.join(side, docs[on].eqNullSafe(side["_picked"]), how)


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int,
                  hot_keys: int = HOT_KEYS, how: str = "inner") -> DataFrame:
    """Give every row its group's columns when one group may hold a third of
    all rows.

    ``groups`` has one row per ``key`` with its row count in ``size``, and
    ``n_rows`` is the number of rows. Fewer than ``hot_keys`` groups can hold
    at least n_rows / hot_keys rows each, so that many keys are broadcast and
    their rows never move; the rest meet in a sort-merge join in which no key
    is heavy. Both inputs are read twice, so pass written tables."""
    limit = max(2, math.ceil(n_rows / hot_keys) + 1)
    hot = groups.filter(F.col(size) >= limit)
    cold = groups.filter(F.col(size) < limit)
    heavy = rows.join(F.broadcast(hot), key, "inner")
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return heavy.unionByName(rest.join(cold, key, how), allowMissingColumns=how != "inner")
