"""Benchmark decontamination: containment of short items in long documents.

An item is contained if at least 80 % of its distinct five-word shingles
occur in the document. Items are partitioned by size. Of an item with q
shingles, a document that holds 80 % misses at most floor(0.2 q), so it holds
at least one of any floor(0.2 q) + 1 of them: the item's sketch is that many
smallest shingle hashes (a bottom-k MinHash whose k follows the size class).
A document is in the size partition that tells which classes it can hold, and
keeps the shingle hashes up to the largest sketch value of these; a shared
value makes a candidate. No contained item is missed,
however long the document, and the exact shingle sets decide.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import materialize, numbered, prepare, select_ids

WIDTH = 5
# A sketch table up to this many rows (16 bytes each) is broadcast; a larger
# one meets the documents in a shuffle join.
BROADCAST_ROWS = 1_000_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words: runs without blanks (0x20, 0x09-0x0D)."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.filter(F.split(low, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingled(df: DataFrame, width: int = WIDTH) -> DataFrame:
    """Replaces ``text`` by ``hs``, the 64-bit hashes of its shingles in
    order; shorter texts have one, their whole word sequence, and texts
    without words none. One projection per step: the word array and the word
    hashes are computed once per row, not once per shingle."""
    keep = [c for c in df.columns if c != "text"]
    ws = df.select(*keep, words(F.col("text")).alias("ws"))
    wh = ws.select(*keep, F.transform("ws", lambda w: F.xxhash64(w)).alias("wh"))
    n = F.size("wh")
    at = F.sequence(F.lit(0), F.greatest(n - width, F.lit(0)))
    # beyond the end of a short text get() is null, which the hash leaves out
    hs = F.transform(at, lambda i: F.xxhash64(*[F.get(F.col("wh"), i + k) for k in range(width)]))
    return wh.select(*keep, F.when(n > 0, hs).otherwise(F.array().cast("array<bigint>")).alias("hs"))


def _allowed(q: Column, percent: int) -> Column:
    """How many of q shingles a containing document can lack."""
    return F.floor(q * (100 - percent) / 100)


def item_sketches(items: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(sets, sketches): (item_id, q, h) for all shingles, and (item_id,
    size_class, h) for each item's smallest hashes."""
    sets = shingled(items.select(F.col("item_id").cast("long").alias("item_id"), "text")).withColumn("hs", F.array_distinct("hs"))
    sets = sets.filter(F.size("hs") > 0).withColumn("q", F.size("hs").cast("long"))
    sketches = sets.select("item_id", F.floor(F.log2("q")).cast("int").alias("size_class"),
                           F.explode(F.slice(F.array_sort("hs"), 1, (_allowed(F.col("q"), percent) + 1).cast("int"))).alias("h"))
    return sets.select("item_id", "q", F.explode("hs").alias("h")), sketches


def contained_items(docs: DataFrame, items: DataFrame, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment) for every pair
    with 100 * shared >= percent * item_shingles.

    Items or documents that are null, empty or blank match nothing. An item
    of fewer than five words is one shingle, its word sequence, and is found
    only in a document that is that sequence. Rows with a null id are not
    searched. Repeated items and documents give their pair once. Empty tables
    give no rows."""
    spark = docs.sparkSession
    prepare(spark)
    sets, sketches = item_sketches(items.filter(F.col("item_id").isNotNull()), percent)
    sets, sketches = materialize(sets.distinct(), "items"), materialize(sketches.distinct(), "item-sketches")
    classes = sketches.groupBy("size_class").agg(F.max("h").alias("top"), F.count(F.lit(1)).alias("n")).collect()
    n = sum(r["n"] for r in classes)
    if not n:
        return spark.createDataFrame([], "doc_id long, item_id long, shared long, item_shingles long, containment double")
    small = n <= BROADCAST_ROWS
    hashed = shingled(docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    # a class of at least 2 ** c shingles needs a document of percent of that
    limits = [F.when(F.size("hs") * 100 >= percent * 2 ** r["size_class"], F.lit(r["top"])) for r in classes]
    limited = hashed.withColumn("top", F.greatest(*limits) if len(limits) > 1 else limits[0])
    low = limited.select("doc_id", F.explode(F.filter("hs", lambda h: h <= F.col("top"))).alias("h"))
    side = sketches.select("item_id", "h")
    pairs = materialize(low.join(F.broadcast(side) if small else side, "h").select("doc_id", "item_id").distinct(), "leak-candidates")
    # exact: all shingles of the candidate documents against their items' sets
    found = hashed.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi")
    found = found.select("doc_id", F.explode(F.array_distinct("hs")).alias("h"))
    n_sets = sets.count()
    hits = found.join(F.broadcast(sets) if n_sets <= BROADCAST_ROWS else sets, "h")
    counts = hits.groupBy("doc_id", "item_id", "q").agg(F.countDistinct("h").alias("shared"))
    out = counts.join(pairs, ["doc_id", "item_id"], "left_semi").filter(F.col("shared") * 100 >= F.col("q") * percent)
    return out.select("doc_id", "item_id", "shared", F.col("q").alias("item_shingles"), (F.col("shared") / F.col("q")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """All columns of the rows whose text contains no item.

    Every row and every item is judged by its own text, whatever their ids:
    null and repeated ids make no difference, and rows that repeat a text go
    or stay together. Null, empty and blank texts stay, such items match
    nothing. Empty tables are allowed. The texts move at most once."""
    names = docs.columns
    rows, key = numbered(docs, "decontamination-rows")
    asked, number = numbered(items.select("text"), "decontamination-items")
    bad = contained_items(rows, asked.select(F.col(number).alias("item_id"), "text"), percent, id_col=key).select("doc_id").distinct()
    return select_ids(rows, materialize(bad, "leaks"), "left_anti", key).select(*names)
