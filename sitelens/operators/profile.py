"""Table profiling aggregates.

Each aggregate is one ``agg`` (partial aggregation map-side, one shuffle of
partial buffers); quantiles are exact and distributed (``quantiles``). Where a
second pass needs a fitted number (quartiles,
histogram bounds) the one-row result is read on the driver and used as a
literal, exactly like a fitted model parameter: a handful of doubles, never
table data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.operators.quantiles import quantiles


def eda_metrics(df: DataFrame, price_col: str) -> DataFrame:
    """Eight headline numbers (A1); avg_rating is over rows with price and rating."""
    has_price = F.col(price_col).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("n_venues"),
        F.countDistinct("city").alias("n_cities"),
        F.avg(price_col).alias("avg_price"),
        F.lit(quantiles(df, price_col, {"m": 0.5})["m"]).cast("double").alias("median_price"),
        F.avg(F.when(has_price, F.col("rating"))).alias("avg_rating"),
        F.count(F.when(F.col("rating").isNull(), 1)).alias("null_ratings"),
        F.count(F.when(F.col("price_source") == "estimated", 1)).alias("estimated_prices"),
        F.countDistinct("name").alias("unique_venues"),
    )


def quality_counts(raw: DataFrame, clean: DataFrame, filtered: DataFrame) -> DataFrame:
    """Raw, clean and filtered row counts plus quality counts of the clean
    table (A2). One scan of a tagged union, one aggregate."""
    def tag(df: DataFrame, t: int) -> DataFrame:
        return df.select(F.lit(t).alias("_t"), F.col("city").cast("string").alias("city"),
                         F.col("rating").cast("double").alias("rating") if t else F.lit(None).cast("double").alias("rating"),
                         F.col("price_source"))
    u = tag(raw, 0).unionByName(tag(clean, 1)).unionByName(tag(filtered, 2))
    is_clean = F.col("_t") == 1
    return u.agg(
        F.count(F.when(F.col("_t") == 0, 1)).alias("raw_rows"),
        F.count(F.when(is_clean, 1)).alias("clean_rows"),
        F.count(F.when(F.col("_t") == 2, 1)).alias("filtered_rows"),
        F.count(F.when(is_clean & F.col("rating").isNull(), 1)).alias("null_ratings"),
        F.countDistinct(F.when(is_clean, F.col("city"))).alias("cities"),
        F.count(F.when(is_clean & (F.col("price_source") == "estimated"), 1)).alias("estimated"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: engine type name, non-null, null count and null % with one
    decimal (A3; null for an empty table). One aggregate over all columns,
    then unpivoted."""
    cols = df.columns
    stats = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(f"`{c}`")).alias(f"_nn{i}") for i, c in enumerate(cols)])
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    entries = F.array(*[F.struct(F.lit(i).cast("int").alias("pos"), F.lit(c).alias("column"),
                                 F.lit(types[c]).alias("dtype"), F.col(f"_nn{i}").alias("non_null"))
                        for i, c in enumerate(cols)])
    long = stats.select("_n", F.explode(entries).alias("e")).select("_n", "e.*")
    pct = F.round(F.when(F.col("_n") > 0, F.col("nulls") * 100.0 / F.col("_n")), 1)
    return (long.withColumn("nulls", F.col("_n") - F.col("non_null"))
            .withColumn("null_pct", F.concat(pct.cast("string"), F.lit("%")))
            .select("pos", "column", "dtype", "non_null", "nulls", "null_pct"))


def city_list(df: DataFrame) -> DataFrame:
    """Sorted distinct non-null cities (A4)."""
    return df.select("city").where(F.col("city").isNotNull()).distinct().orderBy("city")


def price_bounds(df: DataFrame, price_col: str) -> DataFrame:
    """Integer slider bounds: int(min), int(max) of a price column (A5)."""
    return df.agg(F.min(price_col).cast("int").alias("price_min"),
                  F.max(price_col).cast("int").alias("price_max"))


def rated_priced(df: DataFrame, price_col: str) -> DataFrame:
    return df.filter(F.col("rating").isNotNull() & F.col(price_col).isNotNull())


def price_rating_corr(df: DataFrame, price_col: str) -> DataFrame:
    """Pearson r of price and rating over rows with both."""
    base = rated_priced(df, price_col)
    return base.agg(F.count(F.lit(1)).alias("n"), F.corr(price_col, "rating").alias("pearson_r"))


def price_quartiles(df: DataFrame, price_col: str) -> DataFrame:
    """Exact linear-interpolated quartiles and IQR (A7), one row; null without
    rated and priced rows."""
    q = quantiles(rated_priced(df, price_col), price_col, {"q25": 0.25, "q75": 0.75})
    one = df.sparkSession.createDataFrame([(q["q25"], q["q75"])], "q25 double, q75 double")
    return one.withColumn("iqr", F.col("q75") - F.col("q25"))


def city_price_spread(df: DataFrame, price_col: str) -> DataFrame:
    """max - min of the per-city mean price (A8); null cities are left out."""
    base = rated_priced(df, price_col).filter(F.col("city").isNotNull())
    means = base.groupBy("city").agg(F.avg(price_col).alias("m"))
    return means.agg(F.count(F.lit(1)).alias("n_cities"), (F.max("m") - F.min("m")).alias("spread"))


def pct_in_iqr(df: DataFrame, price_col: str) -> DataFrame:
    """Share (%) of rows whose price lies within [q25, q75]."""
    q = price_quartiles(df, price_col).first()
    base = rated_priced(df, price_col)
    p = F.col(price_col)
    inside = F.when((p >= F.lit(q["q25"])) & (p <= F.lit(q["q75"])), 1.0).otherwise(0.0)
    return base.agg((F.avg(inside) * 100).alias("pct_in_iqr"))


def trend_line(df: DataFrame, price_col: str, points: int = 100) -> DataFrame:
    """Least-squares line of rating on price and its ``points`` samples
    evenly spaced from min to max price, last one exactly at max (A10)."""
    base = df.filter(F.col(price_col).isNotNull() & F.col("rating").isNotNull()
                     & F.col("city").isNotNull() & F.col("name").isNotNull())
    fit = base.agg(F.regr_slope("rating", price_col).alias("slope"),
                   F.regr_intercept("rating", price_col).alias("intercept"),
                   F.min(price_col).alias("lo"), F.max(price_col).alias("hi"))
    step = (F.col("hi") - F.col("lo")) / F.lit(points - 1)
    line = fit.select("slope", "intercept", "lo", "hi",
                      F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    x = F.when(F.col("i") == points - 1, F.col("hi")).otherwise(F.col("i") * step + F.col("lo"))
    return line.select("i", "slope", "intercept", x.alias("x")).withColumn(
        "y", F.col("slope") * F.col("x") + F.col("intercept"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram between min and max with every bin present.

    The last bin is closed on the right. Counts come from one grouped
    aggregate; the bin spine (``bins`` rows) is made from the fitted bounds.
    """
    vals = df.filter(F.col(col).isNotNull())
    b = vals.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = b["lo"], b["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, count bigint")
    width = (hi - lo) / bins
    if width > 0:
        idx = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    else:
        idx = F.lit(0)
    counts = vals.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (spine.join(counts, "bin", "left")
            .select("bin",
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                    F.when(F.col("bin") == bins - 1, F.lit(hi))
                    .otherwise(F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def city_rating_top(df: DataFrame, min_venues: int = 5, top_n: int = 20) -> DataFrame:
    """Mean rating and venue count per city, cities with >= ``min_venues``
    rated venues, best ``top_n`` (A12); ties by city. Venues without a city
    count for none."""
    g = (df.filter(F.col("rating").isNotNull() & F.col("city").isNotNull()).groupBy("city")
         .agg(F.avg("rating").alias("avg_rating"), F.count(F.lit(1)).alias("venues"))
         .filter(F.col("venues") >= min_venues))
    return g.orderBy(F.round("avg_rating", 9).desc(), F.col("city")).limit(top_n)


def city_centroids(df: DataFrame) -> DataFrame:
    """Mean position per city."""
    return (df.filter(F.col("city").isNotNull()).groupBy("city")
            .agg(F.avg("lat").alias("lat"), F.avg("lng").alias("lng")))


def label_thresholds(df: DataFrame, price_col: str = "price_nis", rating_col: str = "rating",
                     cuts: Sequence[float] = (0.33, 0.67)) -> DataFrame:
    """33rd/67th percentiles of price and rating, nulls skipped."""
    lo, hi = cuts
    price = quantiles(df, price_col, {"price_33": lo, "price_67": hi})
    rating = quantiles(df, rating_col, {"rating_33": lo, "rating_67": hi})
    return df.sparkSession.createDataFrame([(*price.values(), *rating.values())],
                                           "price_33 double, price_67 double, rating_33 double, rating_67 double")


def deviation_stats(report: DataFrame, threshold: float, col: str = "deviation_m") -> DataFrame:
    """Mean, max, count and share over threshold of deviations."""
    alert = F.col(col) > F.lit(float(threshold))
    return report.agg(F.count(F.lit(1)).alias("n_points"), F.avg(col).alias("mean_dev"),
                      F.max(col).alias("max_dev"), F.count(F.when(alert, 1)).alias("n_alert"),
                      (F.avg(F.when(alert, 1.0).otherwise(0.0)) * 100).alias("pct_alert"))
