"""Point-cloud operators (C1-C15) on tables of points keyed by cloud.

A cloud is a DataFrame ``pt_id, x, y, z`` (optionally ``cloud_id``); a mesh
is ``tri_id, ax, ay, az, bx, by_, bz, cx, cy, cz``. Everything is a join,
aggregate or column expression; NumPy runs inside tasks only for small
fixed-size algebra (3x3 eigenproblems, 4-point rigid fits).
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.hashing import hash32, unit_hash
from sitelens.functions.scalar import deviation_color
from sitelens.operators.grouping import attach
from sitelens.operators.neighbourhood import over_neighbours
from sitelens.operators.ranking import top_k_per_group
from sitelens.operators.spatial import DEFAULT_ROWS_PER_SPLIT, apart, box_candidates, knn_radius, nn_join, split_hot_cells, spread

XYZ = ["x", "y", "z"]


def _debug(msg: str) -> None:
    if os.environ.get("SITELENS_DEBUG"):
        print(f"[sitelens {time.strftime('%H:%M:%S')}] {msg}", file=sys.stderr, flush=True)


def with_cloud(df: DataFrame, cloud_id: int = 1) -> DataFrame:
    return df if "cloud_id" in df.columns else df.withColumn("cloud_id", F.lit(cloud_id).cast("long"))


def cloud_sample(cloud: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """min(n, size) points per cloud without replacement, repeatable."""
    from sitelens.operators.ranking import sample_per_group
    return sample_per_group(with_cloud(cloud), "cloud_id", n, "pt_id", seed)


def voxel_downsample(cloud: DataFrame, voxel: float = 0.05) -> DataFrame:
    """Mean point of each occupied voxel (C4). Voxels are counted from the
    cloud's minimum corner less half a voxel; the per-cloud minimum is one
    grouped aggregate (one row per cloud) that points of large clouds learn
    where they are."""
    c = with_cloud(cloud)
    lo = c.groupBy("cloud_id").agg(*[F.min(a).alias(f"_lo_{a}") for a in XYZ])
    v = F.lit(float(voxel))
    idx = {f"v{a}": F.floor((F.col(a) - (F.col(f"_lo_{a}") - v / 2)) / v).cast("long") for a in XYZ}
    g = attach(c, lo, ["cloud_id"]).withColumns(idx)
    return g.groupBy("cloud_id", "vx", "vy", "vz").agg(
        *[F.avg(a).alias(a) for a in XYZ], F.count(F.lit(1)).alias("n_points"))


def apply_transform(cloud: DataFrame, m: Sequence[Sequence[float]]) -> DataFrame:
    """x' = R x + t for a 4x4 rigid (or affine) matrix."""
    cols = {}
    for i, a in enumerate(XYZ):
        e = F.lit(float(m[i][3]))
        for j, b in enumerate(XYZ):
            e = F.col(b) * F.lit(float(m[i][j])) + e if j == 0 else e + F.col(b) * F.lit(float(m[i][j]))
        cols[a] = e
    return cloud.withColumns(cols)


def cloud_key(*clouds: DataFrame) -> list[str]:
    """The column that keeps clouds of one table apart: ``cloud_id`` where all
    tables have it (point ids may then repeat across clouds)."""
    return ["cloud_id"] if all("cloud_id" in c.columns for c in clouds) else []


def cloud_distance(source: DataFrame, target: DataFrame, **kw) -> DataFrame:
    """Distance of each source point to its nearest target point (C12), of the
    same cloud where both tables name clouds."""
    by = cloud_key(source, target)
    nn = nn_join(source, target, XYZ, q_id="pt_id", t_id="pt_id", by=by, **kw)
    return source.join(apart(nn), [*by, "pt_id"]).withColumnRenamed("nn_dist", "deviation_m")


def align_quality(source: DataFrame, target: DataFrame, max_dist: float) -> DataFrame:
    """fitness = share of source points with a target within ``max_dist``;
    inlier_rmse = root mean square of those distances (C11). An empty source
    has no fitness (null). A row per cloud where both tables name clouds."""
    by = cloud_key(source, target)
    nn = nn_join(source, target, XYZ, q_id="pt_id", t_id="pt_id", max_dist=max_dist, by=by)
    hit = F.col("nn_id").isNotNull()
    return nn.groupBy(*by).agg(
        F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("fitness"),
        F.sqrt(F.avg(F.when(hit, F.col("nn_dist") * F.col("nn_dist")))).alias("inlier_rmse"),
        F.count(F.when(hit, 1)).alias("n_inliers"))


# --------------------------------------------------------------------------
# Nearest triangle
# --------------------------------------------------------------------------

TRI = ["ax", "ay", "az", "bx", "by_", "bz", "cx", "cy", "cz"]


def triangle_constants_sql() -> dict[str, str]:
    """Per-triangle columns: edge vectors ab, ac and their dot products."""
    out = {}
    for a, (ta, tb, tc) in zip("xyz", [("ax", "bx", "cx"), ("ay", "by_", "cy"), ("az", "bz", "cz")]):
        out[f"ab{a}"] = f"({tb} - {ta})"
        out[f"ac{a}"] = f"({tc} - {ta})"
    out["abab"] = " + ".join(f"ab{a} * ab{a}" for a in "xyz")
    out["abac"] = " + ".join(f"ab{a} * ac{a}" for a in "xyz")
    out["acac"] = " + ".join(f"ac{a} * ac{a}" for a in "xyz")
    return out


TRI_CONST_STAGES = [["abx", "aby", "abz", "acx", "acy", "acz"], ["abab", "abac", "acac"]]


def point_triangle_sql(px: str = "px", py: str = "py", pz: str = "pz") -> tuple[dict[str, str], str]:
    """Unsigned point-triangle distance by the Voronoi regions of the
    triangle (closest point on a vertex, an edge or the face), as SQL
    expressions that Spark and DuckDB evaluate alike. Needs the columns of
    ``triangle_constants_sql``; an edge of length 0 leaves its region to the
    others, so triangles may be degenerate. Per pair only two dot products are formed,
    the other four follow from the triangle constants (bp = ap - ab,
    cp = ap - ac)."""
    st = {"apx": f"({px} - ax)", "apy": f"({py} - ay)", "apz": f"({pz} - az)"}
    st["d1"] = " + ".join(f"ab{a} * ap{a}" for a in "xyz")
    st["d2"] = " + ".join(f"ac{a} * ap{a}" for a in "xyz")
    st.update({"d3": "d1 - abab", "d4": "d2 - abac", "d5": "d1 - abac", "d6": "d2 - acac"})
    st.update({"va": "d3 * d6 - d5 * d4", "vb": "d5 * d2 - d1 * d6", "vc": "d1 * d4 - d3 * d2"})
    conds = ["d1 <= 0 AND d2 <= 0", "d3 >= 0 AND d4 <= d3", "vc <= 0 AND d1 >= 0 AND d3 <= 0 AND abab > 0",
             "d6 >= 0 AND d5 <= d6", "vb <= 0 AND d2 >= 0 AND d6 <= 0 AND acac > 0",
             "va <= 0 AND (d4 - d3) >= 0 AND (d5 - d6) >= 0 AND (d4 - d3) + (d5 - d6) > 0"]
    bc_t = "(d4 - d3) / ((d4 - d3) + (d5 - d6))"
    v_vals = ["0.0E0", "1.0E0", "d1 / (d1 - d3)", "0.0E0", "0.0E0", f"1.0E0 - {bc_t}", "vb / (va + vb + vc)"]
    w_vals = ["0.0E0", "0.0E0", "0.0E0", "1.0E0", "d2 / (d2 - d6)", bc_t, "vc / (va + vb + vc)"]

    def case(vals):
        return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in zip(conds, vals)) + f" ELSE {vals[-1]} END"
    st.update({"tv": case(v_vals), "tw": case(w_vals)})
    comps = [f"(tv * ab{a} + tw * ac{a} - ap{a})" for a in "xyz"]
    return st, "sqrt(" + " + ".join(f"{c} * {c}" for c in comps) + ")"


PAIR_STAGES = [["apx", "apy", "apz"], ["d1", "d2"], ["d3", "d4", "d5", "d6"], ["va", "vb", "vc"], ["tv", "tw"]]


def _tri_constants(df: DataFrame) -> DataFrame:
    tc = triangle_constants_sql()
    for names in TRI_CONST_STAGES:
        df = df.withColumns({n: F.expr(tc[n]) for n in names})
    return df


def _tri_dist_cols(df: DataFrame) -> DataFrame:
    stages, final = point_triangle_sql()
    for names in PAIR_STAGES:
        df = df.withColumns({n: F.expr(stages[n]) for n in names})
    return df.withColumn("tri_dist", F.expr(final)).drop(*[n for g in PAIR_STAGES for n in g])


TRI_AXES = [("ax", "bx", "cx"), ("ay", "by_", "cy"), ("az", "bz", "cz")]
# A point whose bound, or a triangle whose box, spans more than this many cells
# along an axis isn't listed cell by cell but descends the cell hierarchy.
MANY_CELLS = 8


def _grid_pairs(points: DataFrame, tri: DataFrame, lo: dict, hi: dict, side: float, rows_per_split: int, by: Sequence[str]) -> DataFrame:
    """Triangles listed in every cell their box touches meet the points of
    their cloud whose bound reaches the cell, each pair in exactly one shared cell."""
    s = F.lit(side)
    gap = {a: F.greatest(F.lit(lo[a]) - F.col(a), F.col(a) - F.lit(hi[a]), F.lit(0.0)) for a in "xyz"}
    probe = points
    for i, a in enumerate("xyz"):
        others = [b for b in "xyz" if b != a]
        r = F.sqrt(F.greatest(F.col("ub") * F.col("ub") - gap[others[0]] * gap[others[0]]
                              - gap[others[1]] * gap[others[1]], F.lit(0.0)))
        c_lo = F.floor(F.greatest(F.col(a) - r, F.lit(lo[a])) / s).cast("long")
        c_hi = F.floor(F.least(F.col(a) + r, F.lit(hi[a])) / s).cast("long")
        probe = (probe.withColumn(f"_q{i}", c_lo)
                 .withColumn(f"_g{i}", F.explode(F.sequence(c_lo, F.greatest(c_lo, c_hi)))))
    probe = probe.select(*by, "pt_id", F.col("x").alias("px"), F.col("y").alias("py"), F.col("z").alias("pz"), "ub",
                         "_q0", "_q1", "_q2", "_g0", "_g1", "_g2")
    cells = tri
    for i, c in enumerate(TRI_AXES):
        t_lo = F.floor(F.least(*c) / s).cast("long")
        cells = cells.withColumn(f"_t{i}", t_lo).withColumn(
            f"_g{i}", F.explode(F.sequence(t_lo, F.floor(F.greatest(*c) / s).cast("long"))))
    keys = [*by, "_g0", "_g1", "_g2"]
    build, probe, jkeys = split_hot_cells(cells, probe, keys, "tri_id", rows_per_split)
    once = None
    for i in range(3):
        c = F.col(f"_g{i}") == F.greatest(F.col(f"_t{i}"), F.col(f"_q{i}"))
        once = c if once is None else once & c
    return probe.join(apart(build), jkeys).filter(once).select("pt_id", "px", "py", "pz", "ub", *tri.columns)      # tri has ``by``


def _descent_pairs(points: DataFrame, tri: DataFrame, side: float, extent: float, by: Sequence[str], size_class=None) -> DataFrame:
    """Points and the triangles that can be their nearest, by descending the
    cells of the triangles' boxes (triangles of like size share cells)."""
    items = tri.withColumns({"_tid": F.col("tri_id"), "_class": F.lit(0) if size_class is None else size_class,
                             **{f"t_x{i}": F.col(c[0]) for i, c in enumerate(TRI_AXES)},
                             **{f"lo_x{i}": F.least(*c) for i, c in enumerate(TRI_AXES)},
                             **{f"hi_x{i}": F.greatest(*c) for i, c in enumerate(TRI_AXES)}})
    q = points.select(*by, F.col("pt_id").alias("_qid"), *[F.col(a).alias(f"q_x{i}") for i, a in enumerate(XYZ)])
    met = box_candidates(q, items, 3, side, extent, by).withColumnsRenamed(
        {"_qid": "pt_id", **{f"q_x{i}": "p" + a for i, a in enumerate(XYZ)}})
    return met.join(apart(points.select(*by, "pt_id", "ub")), [*by, "pt_id"]).select("pt_id", "px", "py", "pz", "ub", *tri.columns)


def mesh_distance(points: DataFrame, triangles: DataFrame, cell: float | None = None,
                  rows_per_split: int = DEFAULT_ROWS_PER_SPLIT) -> DataFrame:
    """Unsigned distance of each point to the nearest triangle.

    One exact pass, no search rounds:
    1. ``ub`` = distance to the nearest mesh vertex (an NN join), an upper
       bound on the distance to the mesh;
    2. triangles of ordinary size are listed in every grid cell their
       bounding box touches; a near point probes only the cells within
       ``ub``, per axis shrunk by its gap to the mesh's bounding box on the
       other two axes (the closest point of the nearest triangle lies inside
       that box), clamped to it. Far points, and all points with regard to
       triangles of many cells, descend the cell hierarchy instead;
    3. a box-distance lower bound drops triangles farther than ``ub`` before
       the exact point-triangle distance, and one aggregate (least distance,
       then least id) picks the winner.

    Where both tables have ``cloud_id``, points meet the triangles of their own
    cloud only, and ids may repeat across clouds. A point whose cloud has no
    triangles has a null distance.
    Output: cloud_id (as above), pt_id, x, y, z, deviation_m, tri_id.
    """
    by = cloud_key(points, triangles)
    tri = spread(_tri_constants(triangles.select(*by, "tri_id", *[F.col(c).cast("double").alias(c) for c in TRI])))
    pts = spread(points.select(*by, "pt_id", *[F.col(a).cast("double").alias(a) for a in XYZ]))
    st = tri.agg(F.least(F.min("ax"), F.min("bx"), F.min("cx")).alias("lox"),
                 F.greatest(F.max("ax"), F.max("bx"), F.max("cx")).alias("hix"),
                 F.least(F.min("ay"), F.min("by_"), F.min("cy")).alias("loy"),
                 F.greatest(F.max("ay"), F.max("by_"), F.max("cy")).alias("hiy"),
                 F.least(F.min("az"), F.min("bz"), F.min("cz")).alias("loz"),
                 F.greatest(F.max("az"), F.max("bz"), F.max("cz")).alias("hiz"),
                 F.avg(F.greatest(F.greatest("ax", "bx", "cx") - F.least("ax", "bx", "cx"),
                                  F.greatest("ay", "by_", "cy") - F.least("ay", "by_", "cy"),
                                  F.greatest("az", "bz", "cz") - F.least("az", "bz", "cz"))).alias("size"),
                 F.count(F.lit(1)).alias("n")).first()
    if st["n"] == 0:
        return pts.withColumn("deviation_m", F.lit(None).cast("double")).withColumn("tri_id", F.lit(None).cast("long"))
    lo = {a: st["lo" + a] for a in "xyz"}
    hi = {a: st["hi" + a] for a in "xyz"}
    extent = max(max(hi[a] - lo[a] for a in "xyz"), 1e-12)
    side = cell or max(st["size"] or extent, extent * 1e-6)

    # 1. upper bound from the nearest vertex
    corners = [("ax", "ay", "az"), ("bx", "by_", "bz"), ("cx", "cy", "cz")]
    verts = None
    for cx_, cy_, cz_ in corners:
        v = tri.select(*by, F.col(cx_).alias("x"), F.col(cy_).alias("y"), F.col(cz_).alias("z"))
        verts = v if verts is None else verts.unionByName(v)
    verts = verts.distinct().withColumn("pt_id", F.xxhash64("x", "y", "z"))
    ub = nn_join(pts, verts, XYZ, q_id="pt_id", t_id="pt_id", collapse_copies=False, by=by).select(
        *by, "pt_id", (F.col("nn_dist") * F.lit(1.0 + 1e-9) + F.lit(1e-12)).alias("ub"))

    q = pts.join(apart(ub), [*by, "pt_id"]).checkpoint()
    size = F.greatest(*[F.greatest(*c) - F.least(*c) for c in TRI_AXES])
    tri = tri.withColumn("_size", size).checkpoint()
    small, large = tri.filter(F.col("_size") <= MANY_CELLS * side).drop("_size"), tri.filter(F.col("_size") > MANY_CELLS * side)
    near, far = q.filter(F.col("ub") <= MANY_CELLS * side), q.filter(F.col("ub") > MANY_CELLS * side)
    cand = _grid_pairs(near, small, lo, hi, side, rows_per_split, by)
    if not far.isEmpty():
        cand = cand.unionByName(_descent_pairs(far, small, side, extent, by))
    if not large.isEmpty():
        cand = cand.unionByName(_descent_pairs(q, large.drop("_size"), side, extent, by, F.floor(F.log2(size / side)).cast("int")))

    # cheap bound first, exact distance, narrow argmin
    lb2 = None
    for p_, c in zip(("px", "py", "pz"), TRI_AXES):
        g = F.greatest(F.least(*c) - F.col(p_), F.col(p_) - F.greatest(*c), F.lit(0.0))
        lb2 = g * g if lb2 is None else lb2 + g * g
    pairs = _tri_dist_cols(cand.filter(lb2 <= F.col("ub") * F.col("ub")))
    # one pass: a second read of the pairs would form them again, and a condition on the distance would be
    # taken apart into the pair's columns, too much code to be compiled
    first = F.min(F.when(F.col("tri_dist").isNotNull(), F.struct("tri_dist", "tri_id")))
    best = pairs.groupBy(*by, "pt_id").agg(first.alias("_m")).select(*by, "pt_id", F.col("_m.tri_dist").alias("deviation_m"), F.col("_m.tri_id").alias("tri_id"))
    return pts.join(apart(best), [*by, "pt_id"], "left").select(
        *pts.columns, "deviation_m", "tri_id")


# --------------------------------------------------------------------------
# Deviation report and dashboard data
# --------------------------------------------------------------------------

def deviation_report(dist: DataFrame, threshold: float = 0.05, max_color_dist: float = 0.2) -> DataFrame:
    """x, y, z, deviation_m, alert (d > threshold) and the colour (C14, P15,
    P16), with ``cloud_id`` where the distances have it."""
    return dist.select(*cloud_key(dist), "pt_id", "x", "y", "z", "deviation_m",
                       (F.col("deviation_m") > F.lit(float(threshold))).alias("alert"),
                       *deviation_color("deviation_m", max_color_dist))


def alert_table(report: DataFrame, threshold: float, n: int = 500) -> DataFrame:
    """Points over threshold, largest deviation first, first n."""
    a = report.filter(F.col("deviation_m") > F.lit(float(threshold)))
    return a.orderBy(F.col("deviation_m").desc(), F.col("pt_id")).limit(n)


REQUIRED_REPORT_COLUMNS = {"x", "y", "z", "deviation_m"}


def check_report_columns(df: DataFrame) -> DataFrame:
    """Raise unless the report has x, y, z and deviation_m."""
    missing = REQUIRED_REPORT_COLUMNS - set(df.columns)
    if missing:
        raise ValueError(f"deviation report must contain columns {sorted(REQUIRED_REPORT_COLUMNS)}; "
                         f"missing {sorted(missing)}")
    return df


# --------------------------------------------------------------------------
# C5 normals
# --------------------------------------------------------------------------

MOMENTS = ["mx", "my", "mz", "sxx", "sxy", "sxz", "syy", "syz", "szz"]


def _block_moments(rows: pd.DataFrame, x: np.ndarray, a: np.ndarray, b: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, dict]:
    """Neighbours and moments of the differences to the point, per point."""
    at = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    k = np.diff(np.r_[at, len(a)])
    d = x[b] - x[a]
    terms = [d[:, 0], d[:, 1], d[:, 2], *[d[:, i] * d[:, j] for i in range(3) for j in range(i, 3)]]
    return a[at], {"k": k, **{m: np.add.reduceat(t, at) / k for m, t in zip(MOMENTS, terms)}}


def _pair_moments(pts: DataFrame, radius: float, max_nn: int, by: Sequence[str]) -> DataFrame:
    """The same from a table of pairs."""
    nb = knn_radius(pts, XYZ, radius, max_nn, id_col="pt_id", by=by)
    j = (nb.join(apart(pts.withColumnsRenamed({"pt_id": "b", **{a: "q" + a for a in XYZ}})), [*by, "b"])
         .join(apart(pts.withColumnsRenamed({"pt_id": "a", **{a: "p" + a for a in XYZ}})), [*by, "a"]))
    # moments of the differences: raw coordinates can be millions of metres
    j = j.select(*by, "a", *[(F.col("q" + a) - F.col("p" + a)).alias("n" + a) for a in XYZ])
    return j.groupBy(*by, F.col("a").alias("pt_id")).agg(
        F.count(F.lit(1)).alias("k"),
        *[F.avg("n" + a).alias("m" + a) for a in XYZ],
        *[F.avg(F.col("n" + a) * F.col("n" + b)).alias(f"s{a}{b}") for a, b in
          [("x", "x"), ("x", "y"), ("x", "z"), ("y", "y"), ("y", "z"), ("z", "z")]])


def estimate_normals(cloud: DataFrame, radius: float, max_nn: int = 30) -> DataFrame:
    """Unit normals from the covariance of each point's hybrid neighbourhood
    (C5): second moments of the differences to the point, summed in blocks
    (``over_neighbours``) -> eigenvector of the smallest eigenvalue, batched NumPy ``eigh`` in
    ``mapInPandas``. Orientation: nz >= 0 (then ny, nx) for repeatability."""
    by = cloud_key(cloud)
    pts = cloud.select(*by, "pt_id", *XYZ)
    mom = over_neighbours(pts, radius, max_nn, by, _block_moments, "k long, " + ", ".join(f"{m} double" for m in MOMENTS),
                          lambda p: _pair_moments(p, radius, max_nn, by))

    def eig(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            mx, my, mz = pdf["mx"].to_numpy(), pdf["my"].to_numpy(), pdf["mz"].to_numpy()
            cov = np.empty((len(pdf), 3, 3))
            cov[:, 0, 0] = pdf["sxx"] - mx * mx
            cov[:, 0, 1] = cov[:, 1, 0] = pdf["sxy"] - mx * my
            cov[:, 0, 2] = cov[:, 2, 0] = pdf["sxz"] - mx * mz
            cov[:, 1, 1] = pdf["syy"] - my * my
            cov[:, 1, 2] = cov[:, 2, 1] = pdf["syz"] - my * mz
            cov[:, 2, 2] = pdf["szz"] - mz * mz
            _, vec = np.linalg.eigh(cov)
            n = vec[:, :, 0]
            flip = (n[:, 2] < 0) | ((n[:, 2] == 0) & ((n[:, 1] < 0) | ((n[:, 1] == 0) & (n[:, 0] < 0))))
            n[flip] *= -1
            few = pdf["k"].to_numpy() < 3
            n[few] = np.array([0.0, 0.0, 1.0])
            yield pd.DataFrame({**{c: pdf[c] for c in by}, "pt_id": pdf["pt_id"], "nx": n[:, 0], "ny": n[:, 1], "nz": n[:, 2]})

    kinds = "".join(f"{c} {cloud.schema[c].dataType.simpleString()}, " for c in by)
    normals = mom.mapInPandas(eig, kinds + "pt_id long, nx double, ny double, nz double")
    return cloud.join(apart(normals), [*by, "pt_id"], "left")


# --------------------------------------------------------------------------
# Even surface sample of a mesh
# --------------------------------------------------------------------------

# Points of one triangle are made in blocks of at most so many.
SAMPLE_BLOCK = 1 << 16
# Candidates that mesh_sample draws, as a multiple of n, before it gives up on a radius.
SAMPLE_TRIES = 30


def _with_area(triangles: DataFrame) -> DataFrame:
    t = triangles.select("tri_id", *[F.col(c).cast("double").alias(c) for c in TRI])
    cx_ = (F.col("by_") - F.col("ay")) * (F.col("cz") - F.col("az")) - (F.col("bz") - F.col("az")) * (F.col("cy") - F.col("ay"))
    cy_ = (F.col("bz") - F.col("az")) * (F.col("cx") - F.col("ax")) - (F.col("bx") - F.col("ax")) * (F.col("cz") - F.col("az"))
    cz_ = (F.col("bx") - F.col("ax")) * (F.col("cy") - F.col("ay")) - (F.col("by_") - F.col("ay")) * (F.col("cx") - F.col("ax"))
    return t.withColumn("area", F.sqrt(cx_ * cx_ + cy_ * cy_ + cz_ * cz_) / 2)


def _draw(t: DataFrame, total: float, largest: float, n: float, seed: int, drawn: float = 0.0) -> DataFrame:
    """Points (tri_id, _i, x, y, z) of the triangles ``t`` with their area:
    those that a sample of about n has beyond one of about ``drawn``. They
    are known by (tri_id, _i), the _i of a triangle running from 0."""
    u = unit_hash("tri_id", f"{seed}:n")

    def upto(m: float) -> F.Column:
        return F.floor(F.lit(float(m)) * F.col("area") / F.lit(total) + u).cast("long")

    s = t.withColumns({"_from": upto(drawn) if drawn else F.lit(0).cast("long"), "_to": upto(n)}).filter(F.col("_to") > F.col("_from"))
    s = s.withColumn("_at", F.explode(F.sequence("_from", F.col("_to") - 1, F.lit(SAMPLE_BLOCK).cast("long"))))
    if (n - drawn) * largest / total > SAMPLE_BLOCK:     # a large triangle's blocks go to many tasks
        par = t.sparkSession.sparkContext.defaultParallelism
        s = s.repartition(max(par, math.ceil((n - drawn) / 1_000_000)), "tri_id", "_at")
    s = s.withColumn("_i", F.explode(F.sequence("_at", F.least(F.col("_at") + SAMPLE_BLOCK, F.col("_to")) - 1)))
    key = F.concat_ws(":", F.col("tri_id").cast("string"), F.col("_i").cast("string"))
    r1, r2 = unit_hash(key, f"{seed}:u"), unit_hash(key, f"{seed}:v")
    sq = F.sqrt(r1)
    wa, wb, wc = F.lit(1.0) - sq, sq * (F.lit(1.0) - r2), sq * r2
    return s.select("tri_id", "_i", *[(wa * F.col(f"a{a}") + wb * F.col("by_" if a == "y" else f"b{a}") + wc * F.col(f"c{a}")).alias(a)
                                      for a in XYZ])


def _point_ids(pts: DataFrame, most: float, far: int) -> DataFrame:
    """pt_id in place of _i: tri_id * 2^20 + _i, the power raised where a
    triangle can have more points than that (``most``); ranks where the
    largest tri_id (``far``) leaves no room for it."""
    bits = max(20, math.ceil(most).bit_length())
    if (far + 1) << bits < 1 << 63:
        ids = pts.withColumn("pt_id", F.col("tri_id").cast("long") * F.lit(1 << bits).cast("long") + F.col("_i"))
    else:
        from sitelens.operators.cluster import global_rank
        ids = global_rank(pts.withColumn("_p", F.struct("tri_id", "_i")), "_p").withColumnRenamed("_rank", "pt_id")
    return ids.select("pt_id", "tri_id", *XYZ)


def _mesh_size(t: DataFrame) -> tuple[float, float, int]:
    """(total area, largest area, largest absolute tri_id)."""
    r = t.agg(F.sum("area"), F.max("area"), F.max(F.abs("tri_id"))).first()
    return float(r[0] or 0.0), float(r[1] or 0.0), int(r[2] or 0)


def _turn(p: str, seed: int) -> F.Column:
    """The place of a point (tri_id, _i) in the order of its draw."""
    return hash32(F.concat_ws(":", F.col(f"{p}.tri_id").cast("string"), F.col(f"{p}._i").cast("string")), seed)


def _spaced(pts: DataFrame, radius: float, seed: int) -> DataFrame:
    """The maximal subset of ``pts`` (with a key ``_p``) without two points
    within the radius that taking them one by one in hash order gives. Each
    round drops the neighbours of points that no remaining one beats."""
    from sitelens.operators.spatial import eps_pairs

    def turn(p: str) -> F.Column:
        return F.struct(_turn(p, seed), F.col(p))

    edges = (eps_pairs(pts, XYZ, radius, id_col="_p", include_self=False).filter(turn("b") < turn("a"))
             .select(F.col("a").alias("loser"), F.col("b").alias("winner")).checkpoint())
    while not edges.isEmpty():
        beaten = edges.select(F.col("loser").alias("winner")).distinct()
        out = edges.join(beaten, "winner", "left_anti").select("loser").distinct().checkpoint()
        pts = pts.join(out.withColumnRenamed("loser", "_p"), "_p", "left_anti").checkpoint()
        edges = (edges.join(out, "loser", "left_anti")
                 .join(out.withColumnRenamed("loser", "winner"), "winner", "left_anti").checkpoint())
    return pts


def mesh_sample(triangles: DataFrame, n: int, seed: int = 42, thin_radius: float | None = None) -> DataFrame:
    """Exactly n points on the mesh surface, no two within ``thin_radius``.

    Points are drawn in rounds: by floor(m * area share + u) per triangle (u a
    seeded hash), where m is n at first and doubles with every round, placed by
    seeded barycentric coordinates. Taken one by one, by round and then in the
    order of a seeded hash, a point stays if none that stayed lies within the
    radius; the first n that stay are the sample. Without a radius one is
    taken from n and the surface (0.7 of the root of area per point) and made
    smaller where n points don't find room, so there are always n. A given
    radius at which ``SAMPLE_TRIES * n`` candidates don't bring n points is an
    error that says how many fit. A mesh without area has no points."""
    from sitelens.operators.cluster import global_rank
    from sitelens.operators.spatial import DEFAULT_ROWS_PER_SPLIT, _pairs_within
    t = _with_area(triangles).checkpoint()
    total, largest, far = _mesh_size(t)
    if total <= 0 or n <= 0:
        return t.sparkSession.createDataFrame([], "pt_id long, tri_id long, x double, y double, z double")
    radius = math.sqrt(total / n / 2) if thin_radius is None else thin_radius
    coords = {a: f"_x{i}" for i, a in enumerate(XYZ)}
    kept, have, drawn, limit = None, 0, 0.0, float(SAMPLE_TRIES) * n
    while have < n:
        upto = max(2.0 * drawn, float(n))
        new = _draw(t, total, largest, upto, seed, drawn).withColumn("_p", F.struct("tri_id", "_i")).checkpoint()
        if kept is not None:
            near = _pairs_within(new.select(F.col("_p").alias("_id"), *[F.col(a).alias(x) for a, x in coords.items()]),
                                 kept.select(F.col("_p").alias("_id"), *[F.col(a).alias(x) for a, x in coords.items()]),
                                 3, radius, DEFAULT_ROWS_PER_SPLIT)
            new = new.join(near.select(F.col("a").alias("_p")).distinct(), "_p", "left_anti").checkpoint()
        new = _spaced(new, radius, seed)
        found = new.count()
        if have + found > n:
            new = (global_rank(new.withColumn("_h", F.struct(_turn("_p", seed), F.col("_p"))), "_h")
                   .filter(F.col("_rank") < n - have).drop("_h", "_rank"))
            found = n - have
        kept = new if kept is None else kept.unionByName(new).checkpoint()
        have, drawn = have + found, upto
        if have < n and drawn >= limit:
            if thin_radius is not None:
                raise ValueError(f"{have} of {n} points found room at a distance of {radius} from each other")
            radius, limit = radius * 0.7, limit + SAMPLE_TRIES * n
    return _point_ids(kept, drawn * largest / total + 1, far)
