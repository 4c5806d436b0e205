"""Exact linear-interpolated quantiles without one task holding all values.

``percentile`` merges a value -> count map of every distinct value in one
task. Here the distinct values with their counts are range-partitioned; a
small table of counts per partition (and group) turns into offsets, and each
partition finds the ranks that fall into it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def group_quantiles(df: DataFrame, group_cols: Sequence[str], col: str, names: dict[str, float]) -> DataFrame:
    """One row per group: its columns and, by name, its quantiles of the
    non-null values of ``col``; no row for a group without values. Null group
    keys form a group. Without ``group_cols`` there is one group."""
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [f"_k{i}" for i in range(len(group_cols))] or ["_k0"]
    named = df.select(*([F.col(g).alias(k) for g, k in zip(group_cols, keys)] or [F.lit(0).alias("_k0")]), F.col(col).cast("double").alias("_v"))
    counts = named.filter(F.col("_v").isNotNull()).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    counts = counts.repartitionByRange(parts, *keys, "_v").withColumn("_p", F.spark_partition_id()).checkpoint()
    # rows before each partition within a group: as many rows as partitions and groups
    sizes = counts.groupBy(*keys, "_p").agg(F.sum("_c").alias("_n"))
    by_group = Window.partitionBy(*keys)
    sizes = sizes.select(*[F.col(k).alias(f"_s{k}") for k in keys], F.col("_p").alias("_sp"), F.sum("_n").over(by_group).alias("_total"),
                         (F.sum("_n").over(by_group.orderBy("_p")) - F.col("_n")).alias("_before"))
    same = [F.col(k).eqNullSafe(F.col(f"_s{k}")) for k in keys] + [F.col("_p") == F.col("_sp")]
    ranked = counts.join(sizes, same).select(*keys, "_p", "_v", "_c", "_total", "_before")
    ranked = ranked.withColumn("_hi", F.col("_before") + F.sum("_c").over(Window.partitionBy(*keys, "_p").orderBy("_v")))
    lo = F.col("_hi") - F.col("_c")
    picks = []
    for name, q in names.items():
        at = F.lit(float(q)) * (F.col("_total") - 1)
        for end, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            picks.append(F.max(F.when((lo <= rank) & (rank < F.col("_hi")), F.col("_v"))).alias(f"_{name}_{end}"))
    found = ranked.groupBy(*keys).agg(F.first("_total").alias("_total"), *picks)
    out = []
    for name, q in names.items():
        at = F.lit(float(q)) * (F.col("_total") - 1)
        a, b = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append(F.when(a == b, a).otherwise((F.ceil(at) - at) * a + (at - F.floor(at)) * b).alias(name))
    return found.select(*[F.col(k).alias(g) for k, g in zip(keys, group_cols)], *out)


def quantiles(df: DataFrame, col: str, names: dict[str, float]) -> dict[str, float | None]:
    """The quantiles of one column as numbers (null without values)."""
    row = group_quantiles(df, [], col, names).first()
    return {n: None if row is None else row[n] for n in names}
