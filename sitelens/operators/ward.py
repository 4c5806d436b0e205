"""Exact Ward clustering (M8) by rounds of reciprocal nearest clusters.

The cost of merging clusters a and b is n_a n_b / (n_a + n_b) |c_a - c_b|^2. It
is reducible: a merged cluster is never nearer to a third one than the nearer of
its parts was. So two clusters that are each other's nearest are merged by the
greedy algorithm too, whatever is merged before them, and all such pairs of a
round merge at once. What comes out is greedy Ward's tree, as a table.

A round only looks for partners up to a cost ``t``, on a grid. A cluster of at
least 2^s rows can reach no larger cluster beyond sqrt(2 t / 2^s), so the side of
a cell follows the size of the smaller partner, and a cluster is listed once for
each size up to its own. ``t`` grows when few clusters are left with a partner
within it, which keeps clusters apart and cells thin; the first ``t`` is chosen by
counting rows per cell. The result doesn't depend on ``t``, and nothing is
compared with everything.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.operators.cluster import connected_components
from sitelens.operators.grouping import attach
from sitelens.operators.spatial import DEFAULT_ROWS_PER_SPLIT, right_size, split_hot_cells
from sitelens.session import scratch_path

# At most so many last clusters are merged on the driver, where a grid has nothing left to prune.
FINISH = 256
# Pairs in cells per cluster that the first threshold may cost.
PAIRS_PER_CLUSTER = 32
# The threshold grows by this factor when fewer than one merge comes to four clusters.
GROWTH = 4.0
MARGIN = 1 + 1e-9
# Modulus and factor that mix the ids of a pair, to order pairs of equal cost.
MIX, FACTOR = 1_000_003, 618_035
TREE = "round int, lo long, hi long, height double, size long"


def _xs(d: int, prefix: str = "") -> list[str]:
    return [f"{prefix}x{i}" for i in range(d)]


def merge_cost(d: int, a: str = "a_", b: str = "b_") -> Column:
    """Cost of merging the clusters in columns ``a_n, a_x0, ...`` and ``b_n, b_x0, ...``."""
    sq = None
    for x in _xs(d):
        t = (F.col(a + x) - F.col(b + x)) * (F.col(a + x) - F.col(b + x))
        sq = t if sq is None else sq + t
    na, nb = F.col(a + "n").cast("double"), F.col(b + "n").cast("double")
    return na * nb / (na + nb) * sq


def _first_threshold(reps: DataFrame, d: int, n: int) -> float:
    """A cost at which the cells of single rows hold few pairs. Starts at about
    one cluster a cell and is cut until counting (map-side combined) agrees; an
    axis on which all rows agree doesn't count."""
    row = reps.agg(*[F.min(x).alias("lo" + x) for x in _xs(d)], *[F.max(x).alias("hi" + x) for x in _xs(d)]).first()
    spans = [s for s in (row["hi" + x] - row["lo" + x] for x in _xs(d)) if s > 0]
    if not spans:
        return 1.0
    side = math.exp((sum(map(math.log, spans)) - math.log(n)) / len(spans))
    least = max(spans) * 2.0 ** -50
    while side > least:
        cells = reps.groupBy(*[F.floor(F.col(x) / F.lit(side)) for x in _xs(d)]).agg(F.count(F.lit(1)).cast("double").alias("m"))
        if cells.agg(F.sum(F.col("m") * F.col("m"))).first()[0] <= PAIRS_PER_CLUSTER * n:
            break
        side /= 4
    return (side / 2) ** 2 / 2


def _pairs(clusters: DataFrame, d: int, t: float, n: int, rows_per_split: int) -> DataFrame:
    """All pairs of clusters whose cost is at most ``t``: lo, hi, height. Each
    pair is found once, in the cells of the smaller one's size."""
    xs = _xs(d)
    radius = F.sqrt(F.lit(2 * t * MARGIN) / F.pow(F.lit(2.0), F.col("s")))
    side = F.lit(2 * MARGIN) * radius

    def cell(v: Column) -> Column:
        return F.floor(v / side)

    own = clusters.withColumn("s", F.floor(F.log2(F.col("n").cast("double")) + 1e-12).cast("int"))
    probe = own.select(F.col("id").alias("a_id"), F.col("s"), F.col("n").alias("a_n"), *[F.col(x).alias("a_" + x) for x in xs],
                       *[F.array_distinct(F.array(cell(F.col(x) - radius), cell(F.col(x) + radius))).alias("_g" + x) for x in xs])
    for x in xs:
        probe = probe.withColumn("_g" + x, F.explode("_g" + x))
    build = own.select(F.col("id").alias("b_id"), F.col("s").alias("b_s"), F.col("n").alias("b_n"),
                       *[F.col(x).alias("b_" + x) for x in xs], F.explode(F.sequence(F.lit(0), F.col("s"))).alias("s"))
    for x in xs:
        build = build.withColumn("_g" + x, cell(F.col("b_" + x)))
    keys = ["s", *["_g" + x for x in xs]]
    if n > rows_per_split:      # no cell can be hot below that
        build, probe, keys = split_hot_cells(build, probe, keys, "b_id", rows_per_split)
    met = probe.join(build, keys).filter((F.col("b_s") > F.col("s")) | (F.col("a_id") < F.col("b_id")))
    return (met.select(F.least("a_id", "b_id").alias("lo"), F.greatest("a_id", "b_id").alias("hi"), merge_cost(d).alias("height"))
            .filter(F.col("height") <= F.lit(t)))


def _reciprocal(pairs: DataFrame) -> DataFrame:
    """Pairs that are the nearest of both their clusters. Equal costs go by the
    ids, mixed first: by plain ids a row of equal gaps would merge one pair a round."""
    mixed = (F.col("lo") % MIX) * (F.col("hi") % MIX) % MIX * FACTOR % MIX
    order = F.struct("height", mixed.alias("mixed"), "lo", "hi")
    ends = pairs.select(F.explode(F.array("lo", "hi")).alias("id"), order.alias("p"))
    best = ends.groupBy("id").agg(F.min("p").alias("p")).select("p.*")
    return best.groupBy("lo", "hi", "height").agg(F.count(F.lit(1)).alias("c")).filter("c = 2").drop("c")


def _merge(clusters: DataFrame, merges: DataFrame, d: int) -> DataFrame:
    """The clusters after the merges: the smaller id stays, centres are weighted means."""
    gone = merges.select(F.col("hi").alias("id"), F.col("lo").alias("_to"))
    n = F.col("n").cast("double")
    mean = {x: F.when(F.count(F.lit(1)) == 1, F.min(x)).otherwise(F.sum(n * F.col(x)) / F.sum(n)).alias(x) for x in _xs(d)}
    return (clusters.join(gone, "id", "left").withColumn("id", F.coalesce("_to", "id"))
            .groupBy("id").agg(F.sum("n").alias("n"), *mean.values()))


def _finish(ids: np.ndarray, n: np.ndarray, x: np.ndarray) -> list[tuple[int, int, float, int]]:
    """Greedy Ward of at most FINISH clusters (or k, if more): (lo, hi, height, size)."""
    order = np.argsort(ids)
    ids, n, x = ids[order], n[order].astype(np.float64), x[order].copy()
    sq = sum((x[:, None, i] - x[None, :, i]) ** 2 for i in range(x.shape[1]))
    cost = n[:, None] * n[None, :] / (n[:, None] + n[None, :]) * sq
    cost[np.tril_indices(len(ids))] = np.inf
    mixed = np.fmod(np.fmod(np.fmod(ids, MIX)[:, None] * np.fmod(ids, MIX)[None, :], MIX) * FACTOR, MIX)
    out = []
    for _ in range(len(ids) - 1):
        ties = np.argwhere(cost == cost.min())      # a before b, so lo and hi
        a, b = min(map(tuple, ties), key=lambda p: (mixed[p], p))
        out.append((int(ids[a]), int(ids[b]), float(cost[a, b]), int(n[a] + n[b])))
        x[a] = (n[a] * x[a] + n[b] * x[b]) / (n[a] + n[b])
        n[a] += n[b]
        cost[b, :] = cost[:, b] = np.inf
        live = np.isfinite(cost[a, :]) | np.isfinite(cost[:, a])
        new = n[a] * n / (n[a] + n) * sum((x[a, i] - x[:, i]) ** 2 for i in range(x.shape[1]))
        rest = np.arange(len(ids))
        cost[a, live & (rest > a)] = new[live & (rest > a)]
        cost[live & (rest < a), a] = new[live & (rest < a)]
    return out


def representatives(points: DataFrame, cols: Sequence[str], id_col: str) -> DataFrame:
    """One row per distinct position: id (the smallest), n, x0, x1, ... Rows
    with a null or NaN coordinate have no position."""
    x = [F.col(c).cast("double") for c in cols]
    known = points.select(F.col(id_col).cast("long").alias("id"), *[c.alias(f"x{i}") for i, c in enumerate(x)])
    for c in _xs(len(cols)):
        known = known.filter(F.col(c).isNotNull() & ~F.isnan(c))
    return known.groupBy(*_xs(len(cols))).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")).select("id", "n", *_xs(len(cols)))


def ward_tree(reps: DataFrame, d: int, k: int = 1, finish: int = FINISH, rows_per_split: int = DEFAULT_ROWS_PER_SPLIT) -> DataFrame:
    """The whole merge tree of weighted positions (id, n, x0, ...): round, lo,
    hi, height, size. A cluster is known by its smallest id, so ``hi`` is
    absorbed by ``lo`` there; one row fewer than positions.

    Each round's merges are a part of one written table (round=N, overwritten if
    the round is run again) and its clusters a checkpoint. The last
    max(``finish``, ``k``) clusters are merged on the driver: as many rows as the
    parameters allow, whatever the input."""
    spark = reps.sparkSession
    clusters = right_size(reps)
    n = clusters.count()
    path = scratch_path(spark, "ward")
    found = spark.createDataFrame([], TREE)
    if n > max(finish, k, 1):
        t = _first_threshold(clusters, d, n)
        rounds = 0
        while n > max(finish, k, 1):
            part = f"{path}/round={rounds}"
            _reciprocal(_pairs(clusters, d, t, n, rows_per_split)).write.mode("overwrite").parquet(part)
            merges = spark.read.schema("lo long, hi long, height double").parquet(part)
            merged = merges.count()
            if merged:
                clusters = _merge(clusters, merges, d).checkpoint()
                n -= merged
            if merged * 4 < n:      # nothing merged: no two clusters lie within t
                t *= GROWTH if merged else GROWTH ** 2
            rounds += 1
        found = (spark.read.schema("lo long, hi long, height double, round int").parquet(path)
                 .select("round", "lo", "hi", "height", F.lit(None).cast("long").alias("size")))
    last = clusters.toPandas()      # at most max(finish, k) rows
    tail = _finish(last["id"].to_numpy(), last["n"].to_numpy(), last[_xs(d)].to_numpy(dtype=float)) if len(last) else []
    return found.unionByName(spark.createDataFrame([(-1, *m) for m in tail], TREE)).drop("size")


def cut_tree(tree: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """The k clusters left when the k - 1 costliest merges are undone: id,
    cluster (0, 1, ... by smallest id). All positions apart if there are fewer
    than k."""
    spark = tree.sparkSession
    undone = tree.orderBy(F.col("height").desc(), F.col("lo").desc(), F.col("hi").desc()).limit(max(k - 1, 0)).select("hi")
    kept = tree.join(F.broadcast(undone), "hi", "left_anti").select(F.col("hi").alias("src"), F.col("lo").alias("dst"))
    comps = connected_components(kept, reps.select(F.col("id").alias("node"))).checkpoint()
    roots = sorted(r["comp"] for r in comps.select("comp").distinct().collect())       # at most k
    numbers = spark.createDataFrame(list(zip(roots, range(len(roots)))), "comp long, cluster int")
    return comps.join(F.broadcast(numbers), "comp").select(F.col("node").alias("id"), "cluster")


def ward(points: DataFrame, cols: Sequence[str], k: int, id_col: str = "row_id", finish: int = FINISH) -> DataFrame:
    """``points`` with ``cluster``: Ward's clustering into k groups, equal to
    greedy Ward on all rows, where equal costs go by the mixed ids of the pair.

    Equal positions merge first, at no cost, so copies always share a cluster and
    fewer than k positions give fewer clusters. Clusters are numbered by their
    smallest id. Rows with a null or NaN coordinate get a null cluster; an empty
    table gives an empty one. Ids are distinct, non-null whole numbers."""
    if k < 1:
        raise ValueError("k must be at least 1")
    d = len(cols)
    reps = representatives(points, cols, id_col).checkpoint()
    labels = cut_tree(ward_tree(reps, d, k, finish), reps, k)
    at = [f"_w{i}" for i in range(d)]
    where = (reps.join(labels, "id").select(*[F.col(x).alias(a) for x, a in zip(_xs(d), at)], F.col("cluster")))
    rows = points.drop("cluster").select("*", *[F.col(c).cast("double").alias(a) for c, a in zip(cols, at)])
    return attach(rows, where, at, "left").drop(*at)
