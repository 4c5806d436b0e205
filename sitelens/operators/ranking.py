"""Persona scoring and ranked lists."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitelens.functions.geo import EARTH_RADIUS_KM
from sitelens.functions.hashing import hash32
from sitelens.operators.grouping import attach
from sitelens.operators.spatial import (BROADCAST_CELLS, CELL_STEP, DEFAULT_ROWS_PER_SPLIT, apart, circle_level, default_cell_deg,
                                        hot_keys, probe_cells, radius_join, split_both, within_radius)

# Persona weights (rating, price, distance). Unknown personas
# use the student row.
PERSONA_WEIGHTS = {
    "student": {"price_nis": -1.5, "rating": 1.0, "distance_km": -0.8},
    "quality": {"price_nis": -0.5, "rating": 2.0, "distance_km": -0.5},
}
DEFAULT_PERSONA = "student"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def persona_weight(persona, feature: str, weights: dict = PERSONA_WEIGHTS) -> Column:
    """Weight lookup as a CASE expression (M14): no join, stays in codegen."""
    p = _c(persona)
    expr = None
    for name, w in weights.items():
        cond = p == F.lit(name)
        expr = F.when(cond, F.lit(w[feature])) if expr is None else expr.when(cond, F.lit(w[feature]))
    return expr.otherwise(F.lit(weights[DEFAULT_PERSONA][feature]))


def persona_score(persona, rating="rating", price="price_nis", distance="distance_km",
                  weights: dict = PERSONA_WEIGHTS) -> Column:
    """score = w_r*rating + w_p*price/10 + w_d*distance, in this term order."""
    return (persona_weight(persona, "rating", weights) * _c(rating)
            + persona_weight(persona, "price_nis", weights) * _c(price) / F.lit(10)
            + persona_weight(persona, "distance_km", weights) * _c(distance))


def top_k_per_group(df: DataFrame, group: Sequence[str] | str, order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """row_number() <= k per group (W1). Catalyst turns the filter into a
    WindowGroupLimit that also runs before the shuffle, so each map task
    sends at most k rows per group however large the group is."""
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def top_k(df: DataFrame, order: Sequence[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """Global top k (T1-T3): orderBy + limit plans as TakeOrderedAndProject,
    a per-partition heap of k rows then one merge; the rank is attached
    after the limit (k rows), not over the whole table."""
    top = df.orderBy(*order).limit(k)
    w = Window.orderBy(*order)
    return top.withColumn(rank_col, F.row_number().over(w))


def hash_threshold(n: int, total: int, slack: float = 1.0) -> float:
    """A 32-bit hash bound expected to keep about 1.2 n of ``total`` rows
    (uniform hash), with a few standard deviations of headroom."""
    if total <= 0:
        return float(1 << 32)
    want = (1.2 * n + 6.0 * math.sqrt(n) + 100.0) * slack
    return min(1.0, want / total) * float(1 << 32)


def sample_rows(df: DataFrame, n: int, id_col: str = "row_id", seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, repeatable for any layout (T4): the n
    smallest seeded hashes (ties by id).

    A plain ``orderBy(hash).limit(n)`` merges every partition's n-row heap in
    one task (partitions x n rows). The hash is uniform, so rows above a
    bound expected to keep ~1.2 n rows are dropped first; the candidate count
    is verified (the bound doubles if it is short, so the result stays
    exact) and only the candidates are ordered."""
    h = hash32(id_col, seed)
    d = df.withColumn("_h", h)
    total = d.count()
    if total <= n:
        return d.orderBy("_h", id_col).drop("_h")
    slack = 1.0
    while True:
        bound = hash_threshold(n, total, slack)
        cand = d.filter(F.col("_h") < F.lit(bound))
        if bound >= float(1 << 32) or cand.count() >= n:
            break
        slack *= 2.0
    return cand.orderBy("_h", id_col).limit(n).drop("_h")


def sample_per_group(df: DataFrame, group: str, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """min(n, group size) rows per group by smallest seeded hash (C1). Per
    group the same hash bound is applied first (group sizes come from one
    grouped count, one row per group), groups whose candidates fall short
    keep all their rows, and the per-group top-n then runs on candidates.
    Groups' numbers reach rows by ``attach``: a group with a third of all rows
    isn't one task's work. Rows with a null group are left out."""
    d = df.withColumn("_h", hash32(id_col, seed))
    sizes = d.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    want = 1.2 * n + 6.0 * math.sqrt(n) + 100.0
    bound = F.least(F.lit(1.0), F.lit(want) / F.col("_n")) * F.lit(float(1 << 32))
    sized = attach(d, sizes, [group]).withColumn("_b", bound)
    cand_n = sized.filter(F.col("_h") < F.col("_b")).groupBy(group).agg(F.count(F.lit(1)).alias("_c"))
    short = sizes.join(cand_n, group, "left").filter(F.coalesce(F.col("_c"), F.lit(0)) < F.least(F.col("_n"), F.lit(n)))
    keep_all = short.select(group, F.lit(True).alias("_all"))
    cand = (attach(sized, keep_all, [group], "left")
            .filter(F.col("_all").isNotNull() | (F.col("_h") < F.col("_b"))))
    out = top_k_per_group(cand, group, [F.col("_h"), F.col(id_col)], n, rank_col="_r")
    return out.drop("_r", "_h", "_n", "_b", "_all")


def score_candidates(pairs: DataFrame, persona_col: str = "persona") -> DataFrame:
    """Eligible candidates (price and rating known) with their persona score."""
    return (pairs.filter(F.col("price_nis").isNotNull() & F.col("rating").isNotNull())
            .withColumn("score", persona_score(persona_col)))


def candidates(queries: DataFrame, venues: DataFrame, *, cell_deg: float | None = None,
               rows_per_split: int | None = None, extra_cols: Sequence[str] = ()) -> DataFrame:
    """Every eligible venue within each query's radius, with its persona
    score (unranked): the radius join plus M15."""
    kwargs = {"cell_deg": cell_deg}
    if rows_per_split is not None:
        kwargs["rows_per_split"] = rows_per_split
    v = venues.select("row_id", "lat", "lng", "name", "city", "rating", "price_nis", "google_maps_url",
                      *extra_cols)
    pairs = radius_join(queries.select("query_id", "lat", "lng", "persona", "max_dist_km"), v, **kwargs)
    return score_candidates(pairs)


RANKED_COLS = ["query_id", "persona", "rank", "row_id", "name", "city", "rating", "price_nis", "distance_km",
               "score", "google_maps_url"]


def rank_candidates(scored: DataFrame, k: int = 10, extra_cols: Sequence[str] = ()) -> DataFrame:
    """Top k per query by score, ties by row_id."""
    ranked = top_k_per_group(scored, "query_id", [F.col("score").desc(), F.col("row_id")], k)
    ranked = ranked.withColumn("rank", F.col("rank").cast("bigint"))
    return ranked.select(*RANKED_COLS, *extra_cols)


# The finest cells hold about so many candidates where they are densest; a cell
# has CELL_STEP x CELL_STEP cells of the next finer level.
LEAF_ROWS = 32
MAX_DEPTH = 8


@dataclass(frozen=True)
class VenueGrid:
    """Eligible venues by cell, ready for any number of query tables.

    ``venues`` holds all of them, with a number ``_v``. ``leaves`` holds, per
    persona, those that can be among a query's top ``k`` (of the venues at one
    place, which are equally far from any query, the first ``k`` by score without
    distance and row_id), by cell of the finest level, ``-depth``. ``cells`` tells per
    level and cell the box around its candidates and the ``k`` largest scores
    without distance."""
    cell_deg: float
    k: int
    extra_cols: tuple[str, ...]
    levels: tuple[int, ...]
    depth: int
    venues: DataFrame
    leaves: DataFrame
    leaves_hot: DataFrame | None
    cells: dict[int, DataFrame]
    rows_per_split: int


def _place_best(static: DataFrame, k: int) -> DataFrame:
    """Of the venues at one place those that can be among a query's first k.
    Scores without distance that differ by rounding alone may tie once the
    distance is added, so those about the k-th best all stay, k of each."""
    place = ["lat", "lng", "_persona"]
    few = top_k_per_group(static, [*place, "_static"], [F.col("row_id"), F.col("_v")], k, "_r").drop("_r").checkpoint()
    kth = (top_k_per_group(few.select(*place, "_static"), place, [F.col("_static").desc()], k, "_r").filter(F.col("_r") == k)
           .select(*place, (F.col("_static") - 1e-9 * (1 + F.abs("_static"))).alias("_kth")))
    return few.join(apart(kth), place, "left").filter(F.col("_kth").isNull() | (F.col("_static") >= F.col("_kth"))).drop("_kth")


def _fine_cells(cell_deg: float, depth: int) -> dict[str, Column]:
    """The finest cell of a venue, so that cells of level 0 are those of ``build_cells``."""
    n_lng, n = int(math.ceil(360.0 / cell_deg)), CELL_STEP ** depth
    fine = cell_deg / n
    y = F.floor((F.col("lat") + 90.0) / F.lit(fine)).cast("long")
    x, coarse = (F.floor((F.col("lng") + 180.0) / F.lit(side)).cast("long") for side in (fine, cell_deg))
    return {"_cy": y, "_cx": F.pmod(coarse, F.lit(n_lng)) * n + (x - coarse * n)}


def venue_grid(venues: DataFrame, cell_deg: float, k: int = 10, extra_cols: Sequence[str] = (),
               rows_per_split: int = DEFAULT_ROWS_PER_SPLIT, levels: Sequence[int] = (0, 1, 2, 3)) -> VenueGrid:
    """Grid the venues once; all tables are checkpointed."""
    v = venues.select("row_id", "lat", "lng", "name", "city", "rating", "price_nis", "google_maps_url", *extra_cols)
    v = v.filter(F.col("price_nis").isNotNull() & F.col("rating").isNotNull() & (F.abs("lat") < float("inf")) & (F.abs("lng") < float("inf")))
    v = v.withColumn("_v", F.monotonically_increasing_id()).checkpoint()
    personas = F.array(*[F.lit(p) for p in PERSONA_WEIGHTS])
    static = (v.select("_v", "row_id", "lat", "lng", "rating", "price_nis").withColumn("_persona", F.explode(personas))
              .withColumn("_static", persona_score("_persona", distance=F.lit(0.0))))
    best = _place_best(static, k).checkpoint()
    most = best.withColumns(_fine_cells(cell_deg, 0)).groupBy("_cy", "_cx", "_persona").count().agg(F.max("count")).first()[0] or 0
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log(max(most / LEAF_ROWS, 1.0), CELL_STEP ** 2))))
    leaves = best.withColumns(_fine_cells(cell_deg, depth)).checkpoint()
    cell = ["_cy", "_cx", "_persona"]
    boxes = [f(c).alias(n) for c, lo, hi in (("lat", "_lo_y", "_hi_y"), ("lng", "_lo_x", "_hi_x")) for f, n in ((F.min, lo), (F.max, hi))]
    at = leaves.groupBy(*cell).agg(*boxes, F.slice(F.sort_array(F.collect_list("_static"), False), 1, k).alias("_top"))
    parent = {"_py": F.floor(F.col("_cy") / CELL_STEP), "_px": F.floor(F.col("_cx") / CELL_STEP)}
    cells = {}
    for level in range(-depth, max(levels) + 1):
        cells[level] = at = at.withColumns(parent).checkpoint()
        at = at.groupBy(F.col("_py").alias("_cy"), F.col("_px").alias("_cx"), "_persona").agg(
            *[f(n).alias(n) for f, n in ((F.min, "_lo_y"), (F.max, "_hi_y"), (F.min, "_lo_x"), (F.max, "_hi_x"))],
            F.slice(F.sort_array(F.flatten(F.collect_list("_top")), False), 1, k).alias("_top"))
    return VenueGrid(cell_deg, k, tuple(extra_cols), tuple(levels), depth, v, leaves, hot_keys(leaves, cell, rows_per_split), cells, rows_per_split)


def _box_distances() -> tuple[Column, Column]:
    """Bounds of the distance in km from a query to the venues in a box: each
    term of the haversine formula at its least and at its largest."""
    y, x = F.col("q_lat"), F.col("q_lng")
    lo_y, hi_y, lo_x, hi_x = (F.col(c) for c in ("_lo_y", "_hi_y", "_lo_x", "_hi_x"))
    zero = F.lit(0.0)
    gaps = [F.greatest(lo_x - x - turn, x + turn - hi_x, zero) for turn in (-360.0, 0.0, 360.0)]
    near_x, far_x = F.least(*gaps, F.lit(180.0)), F.greatest(F.abs(x - lo_x), F.abs(x - hi_x))
    near_y, far_y = F.greatest(lo_y - y, y - hi_y, zero), F.greatest(F.abs(y - lo_y), F.abs(y - hi_y))
    ends = F.cos(F.radians(lo_y)), F.cos(F.radians(hi_y))
    beyond = (lo_y < -90) | (hi_y > 90)
    least = F.when(beyond, -1.0).otherwise(F.least(*ends))
    most = F.when(beyond | ((lo_y <= 0) & (hi_y >= 0)), 1.0).otherwise(F.greatest(*ends))

    def half(d: Column) -> Column:
        return F.when(d >= 180.0, 1.0).otherwise(F.pow(F.sin(F.radians(d) / 2), 2))

    def km(dy: Column, dx: Column, cos_y: Column) -> Column:
        a = half(dy) + F.cos(F.radians(y)) * cos_y * half(dx)
        return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), F.greatest(a, zero))))

    near, far = km(near_y, near_x, least), km(far_y, far_x, most)
    return near * (1 - 1e-7) - 1e-9, far * (1 + 1e-7) + 1e-9


def _still_open(met: DataFrame, k: int) -> DataFrame:
    """The rows (query, cell) whose cell can hold one of the query's top k.
    Cells within the circle promise scores: the best ``_least`` that k venues of a
    cell, or one each of k cells, reach for sure rules out what can't reach it."""
    near, far = _box_distances()
    met = met.withColumns({"_near": near, "_far": far}).filter(F.col("_near") <= F.col("max_dist_km"))
    w = persona_weight("_persona", "distance_km")
    slack = (F.abs(F.get("_top", F.lit(0))) + F.col("_far")) * 1e-9 + 1e-9
    inside = F.col("_far") <= F.col("max_dist_km")
    met = met.withColumns({"_most": F.get("_top", F.lit(0)) + F.greatest(w * F.col("_near"), w * F.col("_far")) + slack,
                           "_one": F.when(inside, F.get("_top", F.lit(0)) + F.least(w * F.col("_near"), w * F.col("_far")) - slack),
                           "_all": F.when(inside, F.get("_top", F.lit(k - 1)) + F.least(w * F.col("_near"), w * F.col("_far")) - slack)})
    every = Window.partitionBy("_q")
    met = met.withColumn("_r", F.row_number().over(every.orderBy(F.col("_one").desc_nulls_last())))
    least = F.greatest(F.max("_least").over(every), F.max("_all").over(every), F.max(F.when(F.col("_r") == k, F.col("_one"))).over(every))
    return (met.withColumn("_least", least).filter(F.col("_least").isNull() | (F.col("_most") >= F.col("_least")))
            .select(*QUERY_COLS, "_least", "_cy", "_cx"))


QUERY_COLS = ["_q", "q_lat", "q_lng", "_persona", "max_dist_km"]


def recommend_on_grid(queries: DataFrame, grid: VenueGrid) -> DataFrame:
    """The ranked top ``grid.k`` of every query (see ``recommend``). Queries of
    one place, radius and persona are answered once. A query starts at the cells
    that cover its circle and descends those that can still hold one of its
    top k by their scores without distance and their box, down to the
    venues of the finest; exact, and the venues met per query don't grow with
    their density."""
    known = F.col("persona").isin(*PERSONA_WEIGHTS)
    q = queries.select("query_id", "lat", "lng", "persona", "max_dist_km").withColumn(
        "_persona", F.when(known, F.col("persona")).otherwise(F.lit(DEFAULT_PERSONA))).withColumnsRenamed({"lat": "q_lat", "lng": "q_lng"})
    alike = ["q_lat", "q_lng", "_persona", "max_dist_km"]
    asked = q.select(*alike).distinct().withColumn("_q", F.monotonically_increasing_id()).checkpoint()
    probe = probe_cells(asked, grid.cell_deg, q_lat="q_lat", q_lng="q_lng", max_level=max(grid.levels)).checkpoint()
    levels = {r["_lv"] for r in probe.select("_lv").distinct().collect()}
    at, kept = ["_cy", "_cx", "_persona"], None
    for level in range(max(levels, default=0), -grid.depth - 1, -1):
        cells = grid.cells[level]
        cells = F.broadcast(cells) if cells.count() <= BROADCAST_CELLS else apart(cells)
        parts = []
        if level in levels:
            start = probe.filter(F.col("_lv") == level).select(*QUERY_COLS, F.lit(None).cast("double").alias("_least"), "_cy", "_cx")
            parts.append(start.join(cells.drop("_py", "_px"), at))
        if kept is not None:
            parts.append(kept.withColumnsRenamed({"_cy": "_py", "_cx": "_px"}).join(cells, ["_py", "_px", "_persona"]).drop("_py", "_px"))
        if parts:
            kept = _still_open(functools.reduce(DataFrame.unionByName, parts), grid.k)
    if kept is None:
        kept = probe.select(*QUERY_COLS, F.lit(None).cast("double").alias("_least"), "_cy", "_cx")
    kept = kept.drop("_least").checkpoint()
    side = kept.withColumn("persona", F.col("_persona"))
    build, side, on = split_both(grid.leaves.select("_v", "row_id", "lat", "lng", "rating", "price_nis", *at), side, at, grid.leaves_hot,
                                 hot_keys(kept, at, grid.rows_per_split))
    scored = score_candidates(within_radius(side, build, on)).select("_q", "_v", "row_id", "distance_km", "score")
    first = top_k_per_group(scored, "_q", [F.col("score").desc(), F.col("row_id")], grid.k).drop("rank", "row_id")
    shown = first.join(apart(grid.venues.drop("lat", "lng")), "_v").join(apart(asked), "_q").drop("_q", "_v")
    return rank_candidates(q.join(apart(shown), alike), grid.k, grid.extra_cols)


def recommend(queries: DataFrame, venues: DataFrame, k: int = 10, *, cell_deg: float | None = None,
              rows_per_split: int = DEFAULT_ROWS_PER_SPLIT, extra_cols: Sequence[str] = ()) -> DataFrame:
    """For every query point: venues within its radius, persona score, top k
    by score (ties by row_id). Output: query_id, persona, rank, row_id, name,
    city, rating, price_nis, distance_km, score, google_maps_url."""
    if cell_deg is None:
        cell_deg = default_cell_deg(queries, "max_dist_km")
    level = circle_level(cell_deg, "max_dist_km")
    found = queries.select(F.col("lat").alias("q_lat"), "max_dist_km").select(level.alias("lv")).distinct().collect()
    used = sorted({x for r in found if r["lv"] is not None for x in (r["lv"], r["lv"] + (r["lv"] > 0))}) or [0]
    return recommend_on_grid(queries, venue_grid(venues, cell_deg, k, extra_cols, rows_per_split, used))


def display_round(df: DataFrame) -> DataFrame:
    """Display projection (P14): distance and score to 2 decimals."""
    return df.withColumns({"distance_km": F.round("distance_km", 2), "score": F.round("score", 2)})


def label_order_key(label) -> list[Column]:
    """Sort keys for cluster labels (T5): Good, Average, other; then
    Affordable, Reasonable, other (substring tests, as the UI does)."""
    lbl = _c(label)
    k1 = F.when(lbl.contains("Good"), 0).when(lbl.contains("Average"), 1).otherwise(2)
    k2 = F.when(lbl.contains("Affordable"), 0).when(lbl.contains("Reasonable"), 1).otherwise(2)
    return [k1.alias("order_quality"), k2.alias("order_price")]
