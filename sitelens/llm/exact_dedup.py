"""Exact de-duplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 digest of the
text. A new batch is reduced to one row per digest (combined map-side), the
digests that the index already holds fall out in a sort-merge anti-join whose
index side is neither shuffled nor read beyond two columns, and the rest is
appended to the same buckets. DataFrame and SQL functions only.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm.common import attach_groups, materialize, numbered, prepare, select_ids
from sitelens.session import scratch_path


class DigestIndex:
    """A digest table at ``path`` with a fixed number of buckets.

    Reopen it with the same ``path`` and ``buckets``; the files and their
    bucket numbers are the whole state, so it outlives the session."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "digest_index_" + hashlib.md5(path.encode()).hexdigest()[:16]
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.name}
            (digest BINARY, keep_id BIGINT, group_size BIGINT, batch STRING) USING parquet
            CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'""")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def unknown(self, groups: DataFrame) -> DataFrame:
        """Rows of ``groups`` whose digest the index lacks."""
        return groups.join(self.read().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add digests (digest, keep_id, group_size). The write commits as a
        whole or not at all; one file per bucket and append."""
        (groups.select("digest", "keep_id", "group_size", F.lit(batch).alias("batch"))
         .repartition(self.buckets, "digest").write.insertInto(self.name))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest): SHA-256 of the unchanged text; null counts as empty."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"))


def _bring(index: DigestIndex, rows: DataFrame, batch: str) -> DataFrame:
    """Append the digests of ``rows`` that the index lacks. Returns the rows'
    groups: digest, keep_id (largest doc_id) and group_size."""
    groups = materialize(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"),
                                                    F.count(F.lit(1)).alias("group_size")), "digest-groups")
    fresh = materialize(index.unknown(groups), "digests-new")
    index.append(fresh, batch)
    return groups


def ingest(index: DigestIndex, docs: DataFrame, batch: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """De-duplicate a batch against the index and append what is new.

    Returns one row per input row: doc_id, digest, keep_id, group_size (rows
    of this batch and the earlier ones with that text, as far as the index
    counted them) and kept. A text that an earlier batch brought keeps its
    earlier row, so all of this batch's copies are dropped. Within a batch the
    largest doc_id stays; a null id counts as smaller than any number, and
    stays only where all ids of the text are null. Rows that repeat id and
    text are the same document and share its decision. Repeating a batch name
    after a failure gives the same result: its own digests don't count as
    known. An empty batch returns no rows and appends nothing."""
    rows = materialize(digests(docs, id_col, text_col), "digests")
    n_rows = rows.count()
    groups = _bring(index, rows, batch)
    known = index.read().select("digest", F.col("keep_id").alias("_first"), F.col("group_size").alias("_size"), "batch")
    decided = groups.join(known.hint("merge"), "digest").select(
        "digest", F.when(F.col("batch") == batch, F.col("keep_id")).otherwise(F.col("_first")).alias("keep_id"),
        (F.col("group_size") + F.when(F.col("batch") == batch, F.lit(0)).otherwise(F.col("_size"))).alias("group_size"),
        F.col("group_size").alias("_rows"), (F.col("batch") == batch).alias("_own"))
    out = attach_groups(rows, materialize(decided, "digests-decided"), "digest", "_rows", n_rows)
    return out.select("doc_id", "digest", "keep_id", "group_size",
                      (F.col("_own") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None,
                batches: int = 1) -> DataFrame:
    """De-duplicate one table through a new index under the shared folder.

    With several batches the ids are cut into so many ranges of about equal
    rows, which the index meets from the largest ids to the smallest and null
    last, so the first row that it has of a text is the one that stays."""
    spark = docs.sparkSession
    prepare(spark)
    buckets = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    index = DigestIndex(spark, scratch_path(spark, "digest-index"), buckets)
    if batches == 1:
        return ingest(index, docs, "batch-0", id_col, text_col)
    rows = materialize(digests(docs, id_col, text_col), "digests")
    n_rows, cuts = rows.agg(F.count(F.lit(1)), F.percentile_approx("doc_id", [i / batches for i in range(1, batches)])).first()
    ends = [None, *sorted(set(cuts or []), reverse=True), None]
    sizes = None
    for i, (high, low) in enumerate(zip(ends, ends[1:])):
        part = rows if high is None else rows.filter((F.col("doc_id") <= high) | F.col("doc_id").isNull())
        part = part if low is None else part.filter(F.col("doc_id") > low)
        groups = _bring(index, part, f"batch-{i}").select("digest", "group_size")
        sizes = groups if sizes is None else sizes.unionByName(groups)
    sizes = sizes.groupBy("digest").agg(F.sum("group_size").alias("group_size"))
    decided = materialize(index.read().select("digest", "keep_id").hint("merge").join(sizes, "digest"), "digests-decided")
    out = attach_groups(rows, decided, "digest", "group_size", n_rows)
    return out.select("doc_id", "digest", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"))


def drop_copies(docs: DataFrame, batches: int = 4) -> DataFrame:
    """All columns of the rows that stay: of equal texts (null counts as empty)
    the one with the largest doc_id (null first; of equal ids any one).

    The rows meet one index in ``batches``, which tells the groups; every row is
    known by a number of its own, so null and repeated ids make no difference.
    An empty table gives no rows. The texts move at most once, to meet the
    rows to drop."""
    names = docs.columns
    rows, key = numbered(docs, "exact-rows")
    groups = exact_dedup(rows, id_col=key, batches=batches).select(F.col("doc_id").alias("_key"), "digest")
    ids = rows.select(F.col(key).alias("_key"), F.col("doc_id").alias("_id"))
    groups = materialize(groups.join(ids, "_key"), "exact-groups")
    stay = groups.groupBy("digest").agg(F.max(F.struct("_id", "_key")).alias("best")).select(F.col("best._key").alias("_key"))
    gone = materialize(groups.join(stay, "_key", "left_anti").select("_key"), "exact-gone")
    return select_ids(rows, gone, "left_anti", key).select(*names)
