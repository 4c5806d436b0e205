"""Neighbour joins on a grid of cells.

Every search here is an equi-join on cell numbers followed by an exact
distance filter, so Spark plans it as an ordinary shuffled (or, when AQE has
measured a small side, broadcast) hash/sort-merge join. Nothing is collected
to the driver except counts of *hot* cells, whose number is bounded by
rows / ``rows_per_split``.

Skew: one cell may hold a third of all rows (a dense city, a scan hot spot).
``split_hot_cells`` counts rows per cell on the build side (map-side combined),
splits every cell above ``rows_per_split`` rows into several salted sub-cells
and replicates only the probe rows of those cells across the sub-cells. Cells
below the limit keep salt 0, so the common case adds no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitelens.functions.geo import EARTH_RADIUS_KM, haversine_km, lat_radius_deg, lng_radius_deg

DEFAULT_ROWS_PER_SPLIT = 200_000
# Hot-cell tables above this many rows are joined by shuffle instead of broadcast.
MAX_BROADCAST_HOT_CELLS = 1_000_000
SALT = "_salt"


def spread(df: DataFrame) -> DataFrame:
    """Checkpoint an input that later rounds re-read; if it turns out to have
    fewer partitions than the cluster has cores (one small file), deal it out
    so exploding and probing run on every core. The partitions are counted on
    the written checkpoint, so the input's own shuffles run once."""
    par = df.sparkSession.sparkContext.defaultParallelism
    df = df.checkpoint()
    return df.repartition(par).checkpoint() if df.rdd.getNumPartitions() < par else df


def right_size(df: DataFrame, rows: int | None = None, rows_per_part: int = 1_000_000) -> DataFrame:
    """Checkpoint an input to iterate over with about ``rows_per_part`` rows
    per partition, never fewer partitions than cores: a small table left at
    200 partitions would run 200 tiny tasks per pass."""
    par = df.sparkSession.sparkContext.defaultParallelism
    df = df.checkpoint()
    n = df.count() if rows is None else rows
    target = max(par, int(math.ceil(n / rows_per_part)))
    have = df.rdd.getNumPartitions()
    if have > 2 * target:
        return df.coalesce(target)
    return df.repartition(par) if have < par else df


def apart(df: DataFrame) -> DataFrame:
    """``df`` for a join that must stay a shuffle join whatever Spark expects of
    its size. Spark guesses that from the columns' share of the compressed files
    and doesn't count the rows that ``explode`` adds, so points or their probe
    cells, which grow with the input, can look small enough to be broadcast
    through the driver."""
    return df.hint("merge")


def split_hot_cells(build: DataFrame, probe: DataFrame, keys: Sequence[str], salt_source: str,
                    rows_per_split: int = DEFAULT_ROWS_PER_SPLIT) -> tuple[DataFrame, DataFrame, list[str]]:
    """Salt hot cells: returns (build, probe, join keys incl. the salt column).

    ``salt_source`` is a build-side column that spreads rows evenly (an id).
    """
    keys = list(keys)
    counts = build.groupBy(*keys).count()
    hot = (counts.filter(F.col("count") > rows_per_split)
           .select(*keys, F.ceil(F.col("count") / F.lit(rows_per_split)).cast("int").alias("_nsplit")))
    hot = hot.checkpoint()
    if not hot.count():
        return build.withColumn(SALT, F.lit(0)), probe.withColumn(SALT, F.lit(0)), [*keys, SALT]
    split = F.when(F.col("_nsplit").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(F.col(salt_source)), F.col("_nsplit")).cast("int"))
    build = build.join(_beside(hot), keys, "left").withColumn(SALT, split).drop("_nsplit")
    every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_nsplit"), F.lit(1)) - 1))
    return build, probe.join(_beside(hot), keys, "left").withColumn(SALT, every).drop("_nsplit"), [*keys, SALT]


def _beside(hot: DataFrame) -> DataFrame:
    return F.broadcast(hot) if hot.count() <= MAX_BROADCAST_HOT_CELLS else hot


def hot_keys(rows: DataFrame, keys: Sequence[str], rows_per_split: int = DEFAULT_ROWS_PER_SPLIT) -> DataFrame | None:
    """The keys with more than ``rows_per_split`` rows and the number of shares
    that theirs are dealt to (``_n``): fewer than rows / ``rows_per_split``.
    None if there are none."""
    n = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows_per_split)
    hot = n.select(*keys, F.ceil(F.col("n") / F.lit(rows_per_split)).cast("int").alias("_n")).checkpoint()
    return hot if hot.count() else None


def split_both(build: DataFrame, probe: DataFrame, keys: Sequence[str], build_hot: DataFrame | None,
               probe_hot: DataFrame | None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Deal the rows of hot keys on both sides: each side's rows go to shares by
    a hash of the row and are repeated for the other side's shares, so a pair
    still meets exactly once, and neither many venues nor many queries of one
    cell are one task's work. Returns (build, probe, join keys)."""
    keys = list(keys)
    if build_hot is None and probe_hot is None:
        return build, probe, keys

    def deal(df: DataFrame, own: DataFrame | None, other: DataFrame | None, own_salt: str, other_salt: str) -> DataFrame:
        columns = df.columns
        for hot, name in ((own, "_mine"), (other, "_theirs")):
            df = df.withColumn(name, F.lit(1)) if hot is None else (
                df.join(_beside(hot.withColumnRenamed("_n", name)), keys, "left").withColumn(name, F.coalesce(F.col(name), F.lit(1))))
        return df.select(*columns, F.pmod(F.xxhash64(*columns), F.col("_mine")).cast("int").alias(own_salt),
                         F.explode(F.sequence(F.lit(0), F.col("_theirs") - 1)).alias(other_salt))

    return deal(build, build_hot, probe_hot, "_sb", "_sp"), deal(probe, probe_hot, build_hot, "_sp", "_sb"), [*keys, "_sb", "_sp"]


# --------------------------------------------------------------------------
# Radius join on the sphere
# --------------------------------------------------------------------------

def default_cell_deg(queries: DataFrame, radius_col: str) -> float:
    """Cell side of half the median search radius: a typical query covers
    about 5x5 cells, which keeps the candidate box close to the circle
    without exploding queries into many cells (measured best on the
    fixture among 1, 1/2 and 1/4 of the median)."""
    med = queries.agg(F.percentile_approx(radius_col, 0.5).alias("m")).first()["m"]
    if med is None or med <= 0:
        return 0.01
    return float(min(max(math.degrees(med / EARTH_RADIUS_KM) / 2.0, 1e-4), 10.0))


def _lat_cell(lat: Column, cell: float) -> Column:
    return F.floor((lat + F.lit(90.0)) / F.lit(cell)).cast("long")


def _lng_cell(lng: Column, cell: float, n_lng: int) -> Column:
    return F.pmod(F.floor((lng + F.lit(180.0)) / F.lit(cell)).cast("long"), F.lit(n_lng))


# A circle spans at most so many cells of its level on either side of its
# centre; cells of the next level are CELL_STEP times as wide.
CELL_REACH = 8
CELL_STEP = 4
# Levels beyond this are never used: their cells would be wider than the globe.
MAX_CELL_LEVEL = 12


def _power(level: Column) -> Column:
    return F.pow(F.lit(float(CELL_STEP)), level).cast("long")


def circle_level(cell_deg: float, radius_col: str, max_level: int = MAX_CELL_LEVEL) -> Column:
    """The level of cells that a query's circle is covered with."""
    dlat = F.least(lat_radius_deg(F.col(radius_col)), F.lit(90.0))
    dlng = F.coalesce(lng_radius_deg(F.col("q_lat"), F.col(radius_col)), F.lit(180.0))
    span = F.sqrt(dlat * dlng) / F.lit(CELL_REACH * cell_deg)
    return F.greatest(F.lit(0), F.least(F.lit(max_level), F.ceil(F.log(float(CELL_STEP), F.greatest(span, F.lit(1e-9)))).cast("int")))


def probe_cells(queries: DataFrame, cell_deg: float, radius_col: str = "max_dist_km", q_lat: str = "lat",
                q_lng: str = "lng", max_level: int = MAX_CELL_LEVEL) -> DataFrame:
    """Every query once per cell (``_lv``, ``_cy``, ``_cx``) of a cover of its
    circle; queries without a position or radius drop out. The position comes
    out as ``q_lat`` / ``q_lng``.

    Cells follow the radius: the wider the circle, the wider the cells at its
    rim, so a query has at most some hundred rows whatever its radius. Of wide
    circles (level 1 and up), blocks of cells that lie inside the circle become
    one cell of the next level."""
    n_lng, n_lat = int(math.ceil(360.0 / cell_deg)), int(math.floor(180.0 / cell_deg))
    margin = 1e-6  # degrees; widens the cover only, the exact filter decides
    q = queries.withColumnsRenamed({q_lat: "q_lat", q_lng: "q_lng"})
    names = q.columns
    q = q.filter(F.col(radius_col).isNotNull() & F.col("q_lat").isNotNull() & F.col("q_lng").isNotNull())
    q = q.withColumns({"_lv": circle_level(cell_deg, radius_col, max_level), "_r": F.radians(lat_radius_deg(F.col(radius_col))),
                       "_dlng": lng_radius_deg(F.col("q_lat"), F.col(radius_col))}).withColumn("_f", _power(F.col("_lv")))
    dlat = lat_radius_deg(F.col(radius_col)) + F.lit(margin)
    lo = F.greatest(_lat_cell(F.col("q_lat") - dlat, cell_deg), F.lit(0))
    hi = F.least(_lat_cell(F.col("q_lat") + dlat, cell_deg), F.lit(n_lat))
    q = q.withColumn("_cy", F.explode(F.sequence(F.floor(lo / F.col("_f")), F.floor(hi / F.col("_f")))))
    # how far the circle reaches east and west within this row of cells
    south = F.col("_cy") * F.col("_f") * F.lit(cell_deg) - F.lit(90.0)
    north = south + F.col("_f") * F.lit(cell_deg)
    widest = F.degrees(F.asin(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.sin(F.radians("q_lat")) / F.cos("_r")))))

    def reach(lat: Column) -> Column:
        at = F.radians(F.greatest(F.least(lat, F.col("q_lat") + F.degrees("_r")), F.col("q_lat") - F.degrees("_r")))
        c = (F.cos("_r") - F.sin(at) * F.sin(F.radians("q_lat"))) / (F.cos(at) * F.cos(F.radians("q_lat")))
        return F.degrees(F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), c))))

    band = F.when((widest >= south - margin) & (widest <= north + margin), F.col("_dlng")).otherwise(F.greatest(reach(south), reach(north)))
    q = q.withColumn("_east", F.when(F.col("_dlng").isNotNull(), F.least(F.col("_dlng"), band) + F.lit(2 * margin)))
    west = F.floor((F.col("q_lng") - F.col("_east") + F.lit(180.0)) / F.lit(cell_deg)).cast("long")
    east = F.floor((F.col("q_lng") + F.col("_east") + F.lit(180.0)) / F.lit(cell_deg)).cast("long")
    q = q.withColumns({"_w": west, "_e": east})
    around = F.col("_east").isNull() | (F.col("_e") - F.col("_w") + 1 >= n_lng)

    def cells(a: Column, b: Column) -> Column:
        return F.sequence(F.floor(a / F.col("_f")), F.floor(b / F.col("_f")))

    first, last = F.pmod(F.col("_w"), F.lit(n_lng)), F.pmod(F.col("_e"), F.lit(n_lng))
    end = F.lit(n_lng - 1).cast("long")
    zero = F.lit(0).cast("long")
    spread_out = F.when(around, cells(zero, end)).when(first <= last, cells(first, last)).otherwise(
        F.array_union(cells(first, end), cells(zero, last)))
    q = q.withColumn("_cx", F.explode(spread_out)).select(*names, "_lv", "_cy", "_cx")
    # a block inside the circle is told by its first cell, under the next level
    block = {"_lv": F.col("_lv") + 1, "_cy": F.floor(F.col("_cy") / CELL_STEP), "_cx": F.floor(F.col("_cx") / CELL_STEP)}
    wide = (F.col("_lv") > 0) & (F.col("_lv") < max_level)
    q = q.withColumn("_block", F.struct(*[c.alias(n) for n, c in block.items()]))
    held = F.coalesce(wide & circle_holds_cell(cell_deg, radius_col, "_block."), F.lit(False))
    q = q.withColumn("_held", held)
    lead = (F.col("_cy") % CELL_STEP == 0) & (F.col("_cx") % CELL_STEP == 0)
    q = q.filter(~F.col("_held") | lead)
    return q.select(*names, *[F.when(F.col("_held"), F.col(f"_block.{n}")).otherwise(F.col(n)).alias(n) for n in block])


def held_probe(probe: DataFrame, rows_per_split: int, keys: Sequence[str] | None = None) -> tuple[DataFrame, list[int], DataFrame | None]:
    """(checkpointed probe rows, the levels they have, their hot keys)."""
    probe = probe.checkpoint()
    n, levels = probe.agg(F.count(F.lit(1)), F.collect_set("_lv")).first()
    return probe, sorted(levels), hot_keys(probe, keys or CELL_KEYS, rows_per_split) if n > rows_per_split else None


def build_cells(venues: DataFrame, cell_deg: float, v_lat: str = "lat", v_lng: str = "lng", levels: Sequence[int] = (0,)) -> DataFrame:
    """Venues with a position, once per level of cells asked for."""
    n_lng = int(math.ceil(360.0 / cell_deg))
    v = venues.filter(F.col(v_lat).isNotNull() & F.col(v_lng).isNotNull()).withColumn("_lv", F.explode(F.array(*[F.lit(x) for x in levels])))
    f = _power(F.col("_lv"))
    return v.withColumns({"_cy": F.floor(_lat_cell(F.col(v_lat), cell_deg) / f), "_cx": F.floor(_lng_cell(F.col(v_lng), cell_deg, n_lng) / f)})


def circle_holds_cell(cell_deg: float, radius_col: str = "max_dist_km", prefix: str = "") -> Column:
    """Whether a probe's circle holds its whole cell: all four corners lie
    within the radius. Along a parallel the distance grows with the difference
    in longitude, and along a meridian it has its maximum at an end as long as
    it stays within a quarter of the globe, so the corners decide; cells over
    a degree are left out for circles beyond that or around a pole. Never at
    the last column of the grid."""
    lv, cy, cx = (F.col(prefix + n) for n in ("_lv", "_cy", "_cx"))
    side = _power(lv) * F.lit(cell_deg)
    south, west = cy * side - F.lit(90.0), cx * side - F.lit(180.0)
    plain = lng_radius_deg(F.col("q_lat"), F.col(radius_col)).isNotNull() & (F.col(radius_col) <= 9000.0) & (side <= 45.0)
    held = ((side <= 1.0) | plain) & (F.abs(south) < 85.0) & (F.abs(south + side) < 85.0) & (west + side < F.lit(180.0))
    for lat in (south, south + side):
        for lng in (west, west + side):
            held = held & (haversine_km("q_lat", "q_lng", lat, lng) <= F.col(radius_col) * F.lit(1 - 1e-9))
    return held


CELL_KEYS = ["_lv", "_cy", "_cx"]


def within_radius(probe: DataFrame, build: DataFrame, keys: Sequence[str], radius_col: str = "max_dist_km",
                  v_lat: str = "lat", v_lng: str = "lng", distance_col: str = "distance_km") -> DataFrame:
    """The pairs of a cell join that lie within the query's radius."""
    pairs = probe.join(apart(build), list(keys), "inner").drop(*CELL_KEYS, *keys)
    return (pairs.withColumn(distance_col, haversine_km("q_lat", "q_lng", v_lat, v_lng))
            .filter(F.col(distance_col) <= F.col(radius_col)))


def radius_join(queries: DataFrame, venues: DataFrame, *, radius_col: str = "max_dist_km",
                q_lat: str = "lat", q_lng: str = "lng", v_lat: str = "lat", v_lng: str = "lng",
                v_id: str = "row_id", cell_deg: float | None = None,
                rows_per_split: int = DEFAULT_ROWS_PER_SPLIT,
                distance_col: str = "distance_km") -> DataFrame:
    """All (query, venue) pairs with haversine distance <= the query's radius.

    Query columns keep their names except ``q_lat``/``q_lng``, which come out
    as ``q_lat``/``q_lng``; venue columns keep theirs. Adds ``distance_col``.
    """
    if cell_deg is None:
        cell_deg = default_cell_deg(queries, radius_col)
    probe, levels, probe_hot = held_probe(probe_cells(queries, cell_deg, radius_col, q_lat, q_lng), rows_per_split)
    build = build_cells(venues, cell_deg, v_lat, v_lng, levels or [0])
    build, probe, keys = split_both(build, probe, CELL_KEYS, hot_keys(build, CELL_KEYS, rows_per_split), probe_hot)
    return within_radius(probe, build, keys, radius_col, v_lat, v_lng, distance_col)


# --------------------------------------------------------------------------
# Euclidean grids
# --------------------------------------------------------------------------

def _cells(cols: Sequence[str], cell: float, prefix: str = "_g") -> dict[str, Column]:
    return {f"{prefix}{i}": F.floor(F.col(c) / F.lit(cell)).cast("long") for i, c in enumerate(cols)}


def _sq_dist(a: Sequence[str], b: Sequence[str]) -> Column:
    terms = [(F.col(x) - F.col(y)) * (F.col(x) - F.col(y)) for x, y in zip(a, b)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def _offsets(dims: int, reach: int) -> list[list[int]]:
    out: list[list[int]] = [[]]
    for _ in range(dims):
        out = [o + [d] for o in out for d in range(-reach, reach + 1)]
    return out


def eps_pairs(points: DataFrame, cols: Sequence[str], eps: float, *, id_col: str = "pt_id",
              include_self: bool = True, rows_per_split: int = DEFAULT_ROWS_PER_SPLIT) -> DataFrame:
    """All ordered pairs (a, b) with Euclidean distance <= eps.

    Grid of side eps: a neighbour lies in one of the 3^d cells around a point.
    Only the probe side is exploded; the build side stays one row per point.
    Output: ``a``, ``b``, ``dist``.
    """
    cols = list(cols)
    d = len(cols)
    base = points.select(F.col(id_col).alias("_id"), *[F.col(c).alias(f"_x{i}") for i, c in enumerate(cols)])
    xs = [f"_x{i}" for i in range(d)]
    build = base.withColumns(_cells(xs, eps)).withColumnsRenamed({"_id": "b", **{x: "b" + x for x in xs}})
    offs = F.array(*[F.array(*[F.lit(v) for v in o]) for o in _offsets(d, 1)])
    probe = (base.withColumns(_cells(xs, eps)).withColumn("_off", F.explode(offs))
             .withColumns({f"_g{i}": F.col(f"_g{i}") + F.col("_off")[i] for i in range(d)})
             .drop("_off").withColumnsRenamed({"_id": "a", **{x: "a" + x for x in xs}}))
    keys = [f"_g{i}" for i in range(d)]
    build, probe, keys = split_hot_cells(build, probe, keys, "b", rows_per_split)
    pairs = probe.join(apart(build), keys, "inner").drop(*keys)
    sq = _sq_dist(["a" + x for x in xs], ["b" + x for x in xs])
    pairs = pairs.withColumn("dist", F.sqrt(sq)).filter(sq <= F.lit(float(eps) * float(eps)))
    if not include_self:
        pairs = pairs.filter(F.col("a") != F.col("b"))
    return pairs.select("a", "b", "dist")


def _pairs_within(probe: DataFrame, build: DataFrame, d: int, r: float, rows_per_split: int,
                  by: Sequence[str] = ()) -> DataFrame:
    """Pairs (a, b, dist) with distance <= r between two point tables with
    columns ``_id`` and ``_x{i}`` (grid of side r, 3^d probe cells), within
    equal ``by`` columns."""
    xs = [f"_x{i}" for i in range(d)]
    b = build.withColumns(_cells(xs, r)).withColumnsRenamed({"_id": "b", **{x: "b" + x for x in xs}})
    offs = F.array(*[F.array(*[F.lit(v) for v in o]) for o in _offsets(d, 1)])
    p = (probe.withColumns(_cells(xs, r)).withColumn("_off", F.explode(offs))
         .withColumns({f"_g{i}": F.col(f"_g{i}") + F.col("_off")[i] for i in range(d)})
         .drop("_off").withColumnsRenamed({"_id": "a", **{x: "a" + x for x in xs}}))
    keys = [*by, *[f"_g{i}" for i in range(d)]]
    b, p, keys = split_hot_cells(b, p, keys, "b", rows_per_split)
    sq = _sq_dist(["a" + x for x in xs], ["b" + x for x in xs])
    return (p.join(apart(b), keys, "inner").withColumn("dist", F.sqrt(sq))
            .filter(sq <= F.lit(float(r) * float(r))).select(*by, "a", "b", "dist"))


def knn_radius(points: DataFrame, cols: Sequence[str], radius: float, max_nn: int, *,
               id_col: str = "pt_id", rows_per_split: int = DEFAULT_ROWS_PER_SPLIT,
               rounds: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """Hybrid search (J4): neighbours within ``radius``, at most ``max_nn``
    nearest per point (self included, ties by id). ``max_nn`` is the
    operator's own definition, not a cost cap. With ``by`` (cloud ids) only
    points with equal values are neighbours, and ids may repeat across them.

    Copies at one place share their neighbours, and only the ``max_nn``
    smallest ids of a place can be anyone's neighbours; so one copy searches,
    few are found, and a group of copies never forms its pairs.

    Growing radii radius/2^rounds, ..., radius: a point with at least
    ``max_nn`` neighbours inside a smaller radius is finished there (all
    points beyond it are farther than those), so in a dense region the pair
    work stays near ``max_nn`` per point; only the others search wider. The
    per-point limit runs map-side first (WindowGroupLimit).
    Output: ``by`` columns, a, b, dist, nn_rank."""
    cols, by = list(cols), list(by)
    d = len(cols)
    xs = [f"_x{i}" for i in range(d)]
    every = points.select(*by, F.col(id_col).alias("_id"), *[F.col(c).cast("double").alias(x) for c, x in zip(cols, xs)])
    every = spread(every)
    places = every.groupBy(*by, *xs).agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_n"))
    copies = not places.filter("_n > 1").isEmpty()
    base, open_pts = every, every
    if copies:
        open_pts = spread(places.drop("_n"))
        first = Window.partitionBy(*by, *xs).orderBy("_id")
        base = spread(every.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= max_nn).drop("_r"))
    w = Window.partitionBy(*by, "a").orderBy(F.col("dist"), F.col("b"))
    parts: list[DataFrame] = []
    # staged radii only pay off where a cell is dense: with at most 2 x
    # max_nn points per cell, one pass already bounds the pairs per point
    top = (base.groupBy(*by, *[F.floor(F.col(x) / F.lit(radius)) for x in xs]).count()
           .agg(F.max("count").alias("m")).first()["m"] or 0)
    staged = top > 2 * max_nn
    radii = ([radius / (2.0 ** k) for k in range(rounds, 0, -1)] if staged else []) + [radius]
    for r in radii:
        pairs = _pairs_within(open_pts, base, d, r, rows_per_split, by)
        if r < radius:
            pairs = pairs.checkpoint()
            done = pairs.groupBy(*by, "a").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") >= max_nn).select(*by, "a")
            done = done.checkpoint()
            pairs = pairs.join(apart(done), [*by, "a"], "left_semi")
        ranked = pairs.withColumn("nn_rank", F.row_number().over(w)).filter(F.col("nn_rank") <= max_nn)
        parts.append(ranked)
        if r < radius:
            open_pts = open_pts.join(apart(done.withColumnRenamed("a", "_id")), [*by, "_id"], "left_anti")
            if open_pts.isEmpty():
                break
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if copies:
        same = every.join(apart(places.select(*by, *xs, F.col("_id").alias("_rep"))), [*by, *xs]).select(*by, F.col("_id"), F.col("_rep").alias("a"))
        out = out.join(apart(same), [*by, "a"]).drop("a").withColumnRenamed("_id", "a")
    return out.select(*by, "a", "b", "dist", "nn_rank")


def argmin_per_key(pairs: DataFrame, key: str | Sequence[str], dist: str, cand: str, carry: Sequence[str] = ()) -> DataFrame:
    """Per ``key`` (a column or several): the smallest ``dist`` and, among equal distances, the
    smallest ``cand``. Two hash aggregates (min distance, then min id over
    the rows at that distance) instead of a min over structs, which Spark
    can only run as a sort-based aggregate over every candidate pair."""
    key = [key] if isinstance(key, str) else list(key)
    slim = pairs.select(*key, cand, dist, *carry)
    best = slim.groupBy(*key).agg(F.min(dist).alias("_best"))
    return (slim.join(best, key).filter(F.col(dist) == F.col("_best"))
            .groupBy(*key).agg(F.min(cand).alias(cand), F.min(dist).alias(dist),
                              *[F.max(c).alias(c) for c in carry]))


def auto_cell(extents: Sequence[float], n: int, per_cell: float = 2.0) -> float:
    """Grid side giving about ``per_cell`` points per occupied cell. Axes
    thinner than the cell are treated as flat, so a surface scan (a sheet in
    3-D) gets a 2-D density estimate instead of a volume one."""
    ext = sorted(max(e, 0.0) for e in extents)
    target = max(1.0, n / per_cell)
    ext = [e for e in ext if e > 0]
    while ext:
        vol = 1.0
        for e in ext:
            vol *= max(e, 1e-300)
        cell = (vol / target) ** (1.0 / len(ext))
        if ext[0] >= cell:
            return cell
        ext = ext[1:]
    return 0.0


# Cells are grouped by this factor per axis from one level to the next.
LEVEL_FACTOR = 4
# A level's cells up to this many (a few numbers each) are broadcast; a finer
# level meets the queries in a shuffle join.
BROADCAST_CELLS = 50_000


def box_candidates(queries: DataFrame, items: DataFrame, d: int, cell: float, extent: float,
                   by: Sequence[str] = ()) -> DataFrame:
    """Pairs (query, item) among which every query's nearest item is, found by
    descending a hierarchy of occupied cells.

    ``queries`` has _qid and q_x0..; ``items`` has _tid, a box (lo_x*, hi_x*)
    and a point of the item (t_x*) per axis, and _class: items of like size,
    so that a large one widens only its own cells. Each level keeps a cell for
    a query if the nearest corner of the box around its items is no farther
    than the nearest known item point of any cell, and splits the kept cells.
    A query far from all items thus meets a few cells per level and the items
    of the last ones, not every item. With ``by`` a query meets only items with
    equal values in these columns. Returns both sides' columns."""
    xs, by = [f"_x{i}" for i in range(d)], list(by)
    n_levels = max(1, math.ceil(math.log(max(extent / cell, 1.0), LEVEL_FACTOR))) + 1
    base = items.withColumns({f"_c{i}": F.floor((F.col("lo" + x) + F.col("hi" + x)) / 2 / F.lit(cell)).cast("long") for i, x in enumerate(xs)})

    def at(level: int, prefix: str) -> list[F.Column]:
        side = LEVEL_FACTOR ** level
        return [F.col("_class").alias(prefix + "class")] + [F.floor(F.col(f"_c{i}") / F.lit(side)).cast("long").alias(f"{prefix}{i}") for i in range(d)]

    def names(prefix: str) -> list[str]:
        return [prefix + "class"] + [f"{prefix}{i}" for i in range(d)]

    kept = queries
    for level in range(n_levels, -1, -1):
        cells = base.select(*by, *at(level, "_k"), *at(level + 1, "_p"), *["lo" + x for x in xs], *["hi" + x for x in xs], *["t" + x for x in xs])
        cells = cells.groupBy(*by, *names("_k"), *names("_p")).agg(
            *[F.min("lo" + x).alias("lo" + x) for x in xs], *[F.max("hi" + x).alias("hi" + x) for x in xs],
            F.min(F.struct(*["t" + x for x in xs])).alias("_at")).checkpoint()
        broadcast = cells.count() <= BROADCAST_CELLS
        side = F.broadcast(cells) if broadcast else cells
        if level == n_levels and by:
            met = kept.join(side.drop(*names("_p")) if broadcast else apart(side.drop(*names("_p"))), by)
        elif level == n_levels:     # the items span at most 2 ** d cells of each class: every query starts at all of them
            top = [F.struct(*[F.lit(r[c]).alias(c) for c in [*names("_k"), *["lo" + x for x in xs], *["hi" + x for x in xs]]],
                            F.struct(*[F.lit(r["_at"]["t" + x]).alias("t" + x) for x in xs]).alias("_at")) for r in cells.collect()]
            met = kept.select("*", F.explode(F.array(*top)).alias("_top")).select("*", "_top.*")
        else:
            met = kept.join(side if broadcast else apart(side), [*by, *names("_p")])
        lo = sum((F.pow(F.greatest(F.col("lo" + x) - F.col("q" + x), F.col("q" + x) - F.col("hi" + x), F.lit(0.0)), 2) for x in xs), F.lit(0.0))
        hi = sum((F.pow(F.col(f"_at.t{x}") - F.col("q" + x), 2) for x in xs), F.lit(0.0))
        met = met.select(*by, "_qid", *["q" + x for x in xs], *names("_k"), lo.alias("_lo"), hi.alias("_hi"))
        best = F.min("_hi").over(Window.partitionBy(*by, "_qid"))
        kept = met.withColumn("_best", best).filter(F.col("_lo") <= F.col("_best") * (1 + 1e-9) + 1e-300)
        kept = kept.select(*by, "_qid", *["q" + x for x in xs], *[F.col(a).alias(b) for a, b in zip(names("_k"), names("_p"))])
    leaves = base.withColumnRenamed("_class", "_pclass").withColumnsRenamed({f"_c{i}": f"_p{i}" for i in range(d)})
    return kept.join(apart(leaves), [*by, *names("_p")]).drop(*names("_p"))


# Queries that share their cell with so many others, on average, meet the targets
# around it through the cell.
QUERIES_PER_HOME = 8


def _around(df: DataFrame, gk: Sequence[str], spans: Sequence[tuple[float, float, float]]) -> DataFrame:
    """Every row once per cell of the block around its own (columns ``gk``) that
    lies between the targets' cells; ``spans``: their least and largest
    coordinate and the side of the cells, per axis."""
    for g, (lo, hi, side) in zip(gk, spans):
        first, last = F.col(g) - 1, F.col(g) + 1
        if lo is not None and math.isfinite(lo) and math.isfinite(hi):
            first, last = F.greatest(first, F.floor(F.lit(float(lo)) / F.lit(side)).cast("long")), F.least(last, F.floor(F.lit(float(hi)) / F.lit(side)).cast("long"))
        met = F.col(g).isNotNull() & (first <= last)      # greatest and least pass over nulls
        df = df.withColumn(g, F.explode(F.when(met, F.sequence(first, last, F.lit(1).cast("long")))))
    return df


def nn_join(queries: DataFrame, targets: DataFrame, cols: Sequence[str], *, q_id: str = "pt_id",
            t_id: str = "pt_id", t_cols: Sequence[str] | None = None, cell: float | None = None,
            rings: int = 3, rows_per_split: int = DEFAULT_ROWS_PER_SPLIT,
            max_dist: float | None = None, collapse_copies: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Exact 1-nearest neighbour of every query point among the targets.
    With ``by`` (cloud ids) only targets with equal values count, and ids may
    repeat across them; queries without such targets have no row.

    Ring growth: in round r the grid side is ``cell * 2**r``; each open query
    probes the 3^d cells around its own. A best hit at distance <= the side is
    final (anything outside the probed block is farther than one side); the
    rest go to the next round with a doubled side. Queries still open after
    ``rings`` rounds lie far from the targets for their density: they descend
    the hierarchy of occupied cells (``box_candidates``) instead, so none of
    them is paired with every target. Exact; ties go to the smallest target id.

    With ``max_dist`` (correspondence search, ICP) only hits within that
    distance are wanted: one round with side >= max_dist is enough and
    queries without a hit come back with null target.

    Output: ``by`` columns, query id as ``q_id``, ``nn_id``, ``nn_dist``.
    """
    cols, by = list(cols), list(by)
    t_cols = list(t_cols) if t_cols is not None else cols
    d = len(cols)
    xs = [f"_x{i}" for i in range(d)]
    # Both sides are read once per round: materialise them (reliable
    # checkpoint in the shared folder) so rounds do not re-run their lineage.
    q_all = queries.select(*by, F.col(q_id).alias("_qid"),
                           *[F.col(c).cast("double").alias("q" + x) for c, x in zip(cols, xs)])
    q_all = spread(q_all)
    # Copies at identical coordinates collapse to their smallest id before
    # the search (exact: same distance, and ties go to the smallest id), so
    # a group of copies holding a third of the table costs one row, not a
    # third of the table per nearby query. The aggregate combines map-side.
    t_all = targets.select(*by, F.col(t_id).alias("_tid"),
                           *[F.col(c).cast("double").alias("t" + x) for c, x in zip(t_cols, xs)])
    if collapse_copies:   # skip only when the caller knows targets are distinct
        t_all = t_all.groupBy(*by, *["t" + x for x in xs]).agg(F.min("_tid").alias("_tid"))
    t_all = spread(t_all)

    stats = t_all.agg(F.count(F.lit(1)).alias("n"),
                      *[F.min("t" + x).alias("lo" + x) for x in xs],
                      *[F.max("t" + x).alias("hi" + x) for x in xs]).first()
    n_t = stats["n"]
    if n_t == 0:
        return q_all.select(*by, F.col("_qid").alias(q_id), F.lit(None).cast("long").alias("nn_id"),
                            F.lit(None).cast("double").alias("nn_dist"))
    qst = q_all.agg(*[F.min("q" + x).alias("lo" + x) for x in xs], *[F.max("q" + x).alias("hi" + x) for x in xs]).first()
    # once the side exceeds the extent of queries and targets together, the
    # 3^d block around any query holds every target: the last round is exact
    extent = 1e-12
    for x in xs:
        lo = min(v for v in (stats["lo" + x], qst["lo" + x]) if v is not None)
        hi = max(v for v in (stats["hi" + x], qst["hi" + x]) if v is not None)
        extent = max(extent, hi - lo)
    if max_dist is not None:
        cell = float(max_dist)
    elif cell is None:
        cell = auto_cell([stats["hi" + x] - stats["lo" + x] for x in xs], n_t)
        cell = extent if cell <= 0 else min(max(cell, extent * 1e-6), extent)
        # a hot spot far denser than the average gets finer starting cells
        # (sparse regions then simply take a few more rings)
        top = (t_all.groupBy(*by, *[F.floor(F.col("t" + x) / F.lit(cell)) for x in xs]).count()
               .agg(F.max("count").alias("m")).first()["m"] or 0)
        if top > 256:
            cell = max(cell / min(16.0, (top / 64.0) ** (1.0 / d)), extent * 1e-6)

    # Per-axis sides. An axis along which the targets are flat (thinner
    # than the cell, e.g. the normal of a scanned surface) gets one cell
    # spanning the joint extent, so every probed block reaches the targets;
    # only the other axes grow round by round.
    joint = []
    for x in xs:
        lo = min(v for v in (stats["lo" + x], qst["lo" + x]) if v is not None)
        hi = max(v for v in (stats["hi" + x], qst["hi" + x]) if v is not None)
        joint.append(max(hi - lo, 1e-12) * 1.0001 + 1e-9)
    sides = [cell] * d
    if max_dist is None:
        for i, x in enumerate(xs):
            if stats["hi" + x] - stats["lo" + x] < cell:
                sides[i] = max(cell, joint[i])
    gaps = [F.greatest(F.lit(stats["lo" + x]) - F.col("q" + x), F.col("q" + x) - F.lit(stats["hi" + x]),
                       F.lit(0.0)) for x in xs]

    done: list[DataFrame] = []
    open_q, n_open = q_all, q_all.count()
    for r in range(rings + 1):
        if r == rings:
            items = t_all.select(*by, "_tid", F.lit(0).alias("_class"), *[F.col("t" + x) for x in xs], *[F.col("t" + x).alias("lo" + x) for x in xs],
                                 *[F.col("t" + x).alias("hi" + x) for x in xs])
            spans = [stats["hi" + x] - stats["lo" + x] for x in xs]
            pairs = box_candidates(open_q, items, d, cell, max(*spans, cell), by)
            sq = _sq_dist(["q" + x for x in xs], ["t" + x for x in xs])
            best = argmin_per_key(pairs.withColumn("_sq", sq), [*by, "_qid"], "_sq", "_tid")
            done.append(best.select(*by, "_qid", F.col("_tid").alias("nn_id"), F.sqrt(F.col("_sq")).alias("nn_dist")))
            break
        # A target outside the probed block is farther than side_i along some
        # axis i that does not cover the joint extent, and along every other
        # axis at least as far as the query's gap to the targets' box: that
        # bound, minimised over i, is the distance up to which a hit is final.
        margins = []
        for i in range(d):
            if sides[i] >= joint[i]:
                continue
            m2 = F.lit(sides[i] * sides[i])
            for j in range(d):
                if j != i:
                    m2 = m2 + gaps[j] * gaps[j]
            margins.append(F.sqrt(m2))
        margin = (F.lit(float("inf")) if not margins else margins[0] if len(margins) == 1
                  else F.least(*margins))
        gk = [f"_g{i}" for i in range(d)]
        build = t_all.withColumns({g: F.floor(F.col("t" + x) / F.lit(sides[i])).cast("long")
                                   for i, (g, x) in enumerate(zip(gk, xs))})
        probe = (open_q.withColumns({g: F.floor(F.col("q" + x) / F.lit(sides[i])).cast("long")
                                     for i, (g, x) in enumerate(zip(gk, xs))})
                 .withColumn("_margin", margin))
        spans = [(stats["lo" + x], stats["hi" + x], side) for x, side in zip(xs, sides)]
        homes = probe.select(*by, *gk).distinct().checkpoint()
        if homes.count() * QUERIES_PER_HOME <= n_open:
            # many queries share a cell: its targets are gathered once, no query is listed in other cells
            hk = [f"_h{i}" for i in range(d)]
            around = _around(homes.withColumns(dict(zip(hk, map(F.col, gk)))), gk, spans)
            build = around.join(apart(build), [*by, *gk]).drop(*gk).withColumnsRenamed(dict(zip(hk, gk)))
        else:
            probe = _around(probe, gk, spans)
        build, probe, jkeys = split_hot_cells(build, probe, [*by, *gk], "_tid", rows_per_split)
        pairs = probe.join(apart(build), jkeys, "inner")
        sq = _sq_dist(["q" + x for x in xs], ["t" + x for x in xs])
        if max_dist is not None:
            pairs = pairs.filter(sq <= F.lit(float(max_dist) ** 2))
        # nearest target per query (ties: smallest id); both aggregates
        # combine map-side, so a hot cell yields one row per query per task
        best = (argmin_per_key(pairs.withColumn("_sq", sq), [*by, "_qid"], "_sq", "_tid", carry=["_margin"])
                .select(*by, "_qid", F.col("_tid").alias("nn_id"), F.sqrt(F.col("_sq")).alias("nn_dist"), "_margin"))
        if max_dist is not None:
            got = open_q.select(*by, "_qid").join(apart(best.drop("_margin")), [*by, "_qid"], "left")
            done.append(got)
            break
        best = best.checkpoint()
        final = best.filter(F.col("nn_dist") <= F.col("_margin")).drop("_margin")
        done.append(final)
        open_q = open_q.join(apart(final.select(*by, "_qid")), [*by, "_qid"], "left_anti")
        n_open = open_q.count()
        if not n_open:
            break
        sides = [sides[i] if sides[i] >= joint[i] else sides[i] * 2.0 for i in range(d)]
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(*by, F.col("_qid").alias(q_id), "nn_id", "nn_dist")
