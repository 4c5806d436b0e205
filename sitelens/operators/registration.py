"""Cloud registration (C6-C9): FPFH features, mutual feature matches,
RANSAC coarse alignment and point-to-plane ICP.

Driver-side state is bounded by parameters: RANSAC hypotheses (``n_hyp``
rows of 12 numbers) and the 6x6 ICP normal equations. Point tables and match
tables stay distributed.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.functions.hashing import hash32
from sitelens.operators.cloud import XYZ, apply_transform, cloud_key
from sitelens.operators.neighbourhood import over_neighbours
from sitelens.operators.spatial import apart, argmin_per_key, knn_radius, right_size

N_BINS = 11


# --------------------------------------------------------------------------
# FPFH (Rusu et al. 2009)
# --------------------------------------------------------------------------

def _cross(a: list[Column], b: list[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def _dot(a: list[Column], b: list[Column]) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def pair_features(pairs: DataFrame) -> DataFrame:
    """Darboux-frame angles of each neighbour pair (p = a, q = b): columns
    f1 (angle in [-pi, pi]), f2, f3 (cosines). The source of the frame is
    the point whose normal makes the smaller angle with the line."""
    p = [F.col(f"a_{c}") for c in XYZ]
    q = [F.col(f"b_{c}") for c in XYZ]
    n1 = [F.col(f"a_n{c}") for c in XYZ]
    n2 = [F.col(f"b_n{c}") for c in XYZ]
    d = [q[i] - p[i] for i in range(3)]
    dist = F.sqrt(_dot(d, d))
    apart_by = F.nullif(dist, F.lit(0.0))       # copies have no line between them
    ang1 = _dot(n1, d) / apart_by
    ang2 = _dot(n2, d) / apart_by
    swap = F.acos(F.least(F.abs(ang1), F.lit(1.0))) > F.acos(F.least(F.abs(ang2), F.lit(1.0)))
    u = [F.when(swap, n2[i]).otherwise(n1[i]) for i in range(3)]
    nt = [F.when(swap, n1[i]).otherwise(n2[i]) for i in range(3)]
    dd = [F.when(swap, -d[i]).otherwise(d[i]) for i in range(3)]
    f3 = F.when(swap, -ang2).otherwise(ang1)
    v = _cross(dd, u)
    vn = F.sqrt(_dot(v, v))
    v = [v[i] / F.nullif(vn, F.lit(0.0)) for i in range(3)]
    w = _cross(u, v)
    f2 = _dot(v, nt)
    f1 = F.atan2(_dot(w, nt), _dot(u, nt))
    ok = (dist > 0) & (vn > 0)
    return pairs.withColumns({"f1": F.when(ok, f1).otherwise(0.0), "f2": F.when(ok, f2).otherwise(0.0),
                              "f3": F.when(ok, f3).otherwise(0.0)})


def _bin(x: Column, lo: float, hi: float) -> Column:
    b = F.floor(F.lit(float(N_BINS)) * (x - F.lit(lo)) / F.lit(hi - lo)).cast("int")
    return F.least(F.greatest(b, F.lit(0)), F.lit(N_BINS - 1))


def _pair_hists(points: DataFrame, radius: float, max_nn: int, by: list[str]) -> DataFrame:
    """pt_id, hist (neighbours per bin) from a table of pairs."""
    nb = knn_radius(points, XYZ, radius, max_nn, id_col="pt_id", by=by).filter(F.col("a") != F.col("b"))
    values = [*XYZ, "nx", "ny", "nz"]
    a = points.select(*by, F.col("pt_id").alias("a"), *[F.col(c).alias(f"a_{c}") for c in values])
    b = points.select(*by, F.col("pt_id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in values])
    pf = pair_features(nb.join(apart(a), [*by, "a"]).join(apart(b), [*by, "b"]))
    pf = pf.withColumns({"h1": _bin(F.col("f1"), -math.pi, math.pi), "h2": _bin(F.col("f2"), -1.0, 1.0),
                         "h3": _bin(F.col("f3"), -1.0, 1.0)}).select(*by, "a", "h1", "h2", "h3")
    bins = [F.count(F.when(F.col(h) == j, 1)).cast("int") for h in ("h1", "h2", "h3") for j in range(N_BINS)]
    return pf.groupBy(*by, F.col("a").alias("pt_id")).agg(F.count(F.lit(1)).alias("n"), F.array(*bins).alias("hist"))


def _block_hists(rows: pd.DataFrame, x: np.ndarray, a: np.ndarray, b: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, dict]:
    """The same of a block's pairs (``pair_features`` on arrays)."""
    ids, normal = rows["pt_id"].to_numpy(), rows[["nx", "ny", "nz"]].to_numpy(np.float64)
    other = ids[a] != ids[b]
    a, b, dist = a[other], b[other], dist[other]
    if not len(a):
        return a, {"n": [], "hist": []}
    n1, n2, d = normal[a], normal[b], x[b] - x[a]
    with np.errstate(all="ignore"):
        dist = np.sqrt((d * d).sum(1))
        ang1, ang2 = (n1 * d).sum(1) / dist, (n2 * d).sum(1) / dist
        swap = np.arccos(np.minimum(np.abs(ang1), 1.0)) > np.arccos(np.minimum(np.abs(ang2), 1.0))
        u, nt = np.where(swap[:, None], n2, n1), np.where(swap[:, None], n1, n2)
        v = np.cross(np.where(swap[:, None], -d, d), u)
        vn = np.sqrt((v * v).sum(1))
        v = v / vn[:, None]
        f = [np.arctan2((np.cross(u, v) * nt).sum(1), (u * nt).sum(1)), (v * nt).sum(1), np.where(swap, -ang2, ang1)]
    ok = (dist > 0) & (vn > 0)
    at = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    which = np.repeat(np.arange(len(at)), np.diff(np.r_[at, len(a)]))
    hist = np.zeros((len(at), 3 * N_BINS), np.int64)
    for k, (c, lo, hi) in enumerate(zip(f, (-math.pi, -1.0, -1.0), (math.pi, 1.0, 1.0))):
        h = np.clip(np.floor(float(N_BINS) * (np.where(ok, c, 0.0) - lo) / (hi - lo)), 0, N_BINS - 1).astype(np.int64)
        hist += np.bincount(which * 3 * N_BINS + k * N_BINS + h, minlength=hist.size).reshape(hist.shape)
    return a[at], {"n": np.diff(np.r_[at, len(a)]), "hist": list(hist.astype(np.int32))}


def _pair_fpfh(points: DataFrame, radius: float, max_nn: int, by: list[str]) -> DataFrame:
    """pt_id, w (the neighbours' SPFH over distance) from a table of pairs."""
    nb = knn_radius(points, XYZ, radius, max_nn, id_col="pt_id", by=by).filter((F.col("a") != F.col("b")) & (F.col("dist") > 0))
    spfh = points.filter(F.col("n") > 0).select(*by, F.col("pt_id").alias("b"), "n", "hist")
    near = nb.join(apart(spfh), [*by, "b"])
    share = [F.sum(F.col("hist")[j] * F.lit(100.0) / F.col("n") / F.col("dist")) for j in range(3 * N_BINS)]
    return near.groupBy(*by, F.col("a").alias("pt_id")).agg(F.array(*share).alias("w"))


def _block_fpfh(rows: pd.DataFrame, x: np.ndarray, a: np.ndarray, b: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, dict]:
    """The same of a block's pairs."""
    ids, n = rows["pt_id"].to_numpy(), rows["n"].to_numpy()
    near = (ids[a] != ids[b]) & (dist > 0) & (n[b] > 0)
    a, b, dist = a[near], b[near], dist[near]
    if not len(a):
        return a, {"w": []}
    used, slot = np.unique(b, return_inverse=True)
    spfh = np.stack(rows["hist"].to_numpy()[used]) * 100.0 / n[used, None]
    at = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    return a[at], {"w": list(np.add.reduceat(spfh[slot] / dist[:, None], at))}


def fpfh_features(cloud: DataFrame, radius: float, max_nn: int = 100) -> DataFrame:
    """33-bin FPFH of every point of a cloud with normals (pt_id, x, y, z,
    nx, ny, nz). SPFH: 11 bins for each of f1, f2, f3 over the hybrid
    neighbourhood, scaled to 100 per block; FPFH = SPFH(p) + the neighbours'
    SPFH weighted by 1/distance, each block rescaled to 100. Both passes over
    the neighbours run in blocks (``over_neighbours``), so no pairs are
    shuffled. Output: (cloud_id,) pt_id, fpfh array<double> (33)."""
    by = cloud_key(cloud)
    key = [*by, "pt_id"]
    points = cloud.select(*key, *XYZ, "nx", "ny", "nz")
    hists = over_neighbours(points, radius, max_nn, by, _block_hists, "n long, hist array<int>",
                            lambda p: _pair_hists(p, radius, max_nn, by)).checkpoint()
    known = cloud.select(*key, *XYZ).join(apart(hists), key, "left").withColumn("n", F.coalesce("n", F.lit(0))).checkpoint()
    near = over_neighbours(known, radius, max_nn, by, _block_fpfh, "w array<double>", lambda p: _pair_fpfh(p, radius, max_nn, by))
    out = cloud.select(*key).join(apart(hists), key, "left").join(apart(near), key, "left")
    blocks = [sum((F.col("w")[k * N_BINS + j] for j in range(N_BINS)), F.lit(0.0)) for k in range(3)]
    own = [F.coalesce(F.col("hist")[j] * F.lit(100.0) / F.col("n"), F.lit(0.0)) for j in range(3 * N_BINS)]
    sums = [F.coalesce(F.when(blocks[j // N_BINS] != 0, F.col("w")[j] * F.lit(100.0) / blocks[j // N_BINS]), F.lit(0.0)) for j in range(3 * N_BINS)]
    return out.select(*key, F.array(*[s + w for s, w in zip(own, sums)]).alias("fpfh"))


# --------------------------------------------------------------------------
# Mutual nearest neighbours in feature space
# --------------------------------------------------------------------------

_NEAR = "side int, id long, other long, fdist double"
AXES_SAMPLE = 2_000          # features that the index's axes are fitted to; they change no result
GAP_AXES = 8                 # leading axes along which rows are told from boxes
BLOCKS_TOGETHER = 30         # blocks of ``block_rows`` rows of a side that meet in one task, at most about
LEAST_FEATURE_GROUP = 2_000  # groups are not made smaller than this to keep the cores busy
FEATURE_TILE = 1_024, 2_048  # source and target rows whose distances are formed at a time


def _axes(tgt: DataFrame, feat: str) -> tuple[np.ndarray, np.ndarray]:
    """Centre and principal axes (columns) of a bounded sample by hash."""
    rows = tgt.select(feat, "pt_id").orderBy(hash32("pt_id", "axes"), "pt_id").limit(AXES_SAMPLE).collect()
    x = np.array([r[feat] for r in rows], np.float64)
    return x.mean(axis=0), np.linalg.svd(x - x.mean(axis=0), full_matrices=True)[2].T


def _tiles(x: np.ndarray, size: int) -> list[np.ndarray]:
    """The rows cut along their widest axis, at its mean (its median, if a part would be
    small), and so on down to ``size``."""
    parts, out = [np.arange(len(x))], []
    while parts:
        part = parts.pop()
        if len(part) <= size:
            out.append(part)
            continue
        v = x[part, int(x[part].var(axis=0).argmax())]
        low = v < v.mean()
        if not len(part) <= 8 * low.sum() <= 7 * len(part):
            low = np.zeros(len(part), bool)
            low[np.argpartition(v, len(part) // 2)[:len(part) // 2]] = True
        parts += [part[~low], part[low]]
    return out


class _Side:
    """A side's rows of a task in tiles of like features: ``x`` exact, ``y``
    along the axes (single precision, for bounds and to choose what is
    compared exactly), and the nearest partner so far."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, centre: np.ndarray, axes: np.ndarray, size: int):
        y = (x - centre) @ axes
        tiles = _tiles(y, size)
        order = np.concatenate(tiles)
        self.ids, self.x, self.y = ids[order], x[order], y[order].astype(np.float32)
        ends = np.cumsum([len(t) for t in tiles])
        self.tiles = [slice(e - len(t), e) for e, t in zip(ends, tiles)]
        self.square = (self.y.astype(np.float64) ** 2).sum(axis=1)
        self.norm = np.sqrt(self.square)
        self.lo, self.hi = (np.array([f(self.y[t], axis=0) for t in self.tiles]) for f in (np.min, np.max))
        self.most = np.array([self.square[t].max() for t in self.tiles])
        # the product of a left and a right row is their squared distance
        one, square = np.ones((len(ids), 1), np.float32), self.square[:, None].astype(np.float32)
        self.left, self.right = np.hstack([-2 * self.y, one, square]), np.hstack([self.y, square, one])
        self.near = np.ascontiguousarray(self.y[:, :GAP_AXES].T)
        self.dist, self.other = np.full(len(ids), np.inf), np.zeros(len(ids), np.int64)

    def nearer(self, rows: np.ndarray, of: "_Side", cols: np.ndarray) -> None:
        """The pairs (rows[i], cols[i]) compared exactly; of equal distances the smaller id."""
        for at in range(0, len(rows), 100_000):
            r, c = rows[at:at + 100_000], cols[at:at + 100_000]
            far, other = np.sqrt(((self.x[r] - of.x[c]) ** 2).sum(axis=1)), of.ids[c]
            order = np.lexsort((other, far, r))
            first = order[np.r_[True, r[order][1:] != r[order][:-1]]]
            r, far, other = r[first], far[first], other[first]
            better = (far < self.dist[r]) | ((far == self.dist[r]) & (other < self.other[r])) | np.isinf(self.dist[r])
            self.dist[r[better]], self.other[r[better]] = far[better], other[better]

    def reaches(self, tile: slice, of: "_Side", box: int) -> np.ndarray:
        """The rows of a tile whose nearest may lie in a box of the other side."""
        gap = np.zeros(tile.stop - tile.start, np.float32)
        for y, lo, hi in zip(self.near[:, tile], of.lo[box], of.hi[box]):
            beside = np.maximum(lo - y, y - hi)
            np.maximum(beside, 0, out=beside)
            gap += beside * beside
        slack = 1e-4 * (1.0 + self.norm[tile] + math.sqrt(of.most[box]))
        return np.flatnonzero(np.sqrt(gap) - slack <= self.dist[tile])


def _compare(a: _Side, r: np.ndarray, b: _Side, c: np.ndarray) -> None:
    """Rows ``r`` of one side against ``c`` of the other, for both. Distances in
    single precision pick the pairs that can be nearest within their rounding."""
    d = a.left[r] @ b.right[c].T
    for one, rows, two, cols, axis in ((a, r, b, c, 1), (b, c, a, r, 0)):
        least, error = d.min(axis=axis), 1e-5 * (one.square[rows] + two.square[cols].max() + 1.0)
        bound = np.minimum(least + 2 * error, one.dist[rows] ** 2 + error)
        asked = np.flatnonzero(least <= bound)
        if len(asked):
            part = d[asked] if axis else d[:, asked].T
            i, j = np.nonzero(part <= bound[asked, None].astype(np.float64))
            one.nearer(rows[asked[i]], two, cols[j])


def _meet(a: _Side, b: _Side, compared=None) -> None:
    """Each row's nearest of the other side, exactly. Pairs of tiles come by the
    distance of their boxes; only rows that may find a nearer partner in the other's
    box are compared."""
    gap = np.zeros((len(a.tiles), len(b.tiles)))
    for k in range(a.y.shape[1]):
        apart_by = np.maximum(np.maximum(b.lo[None, :, k] - a.hi[:, None, k], a.lo[:, None, k] - b.hi[None, :, k]), 0).astype(np.float64)
        gap += apart_by * apart_by
    gap = np.sqrt(gap) - 1e-4 * (1.0 + np.sqrt(a.most)[:, None] + np.sqrt(b.most)[None, :])
    for i, j in zip(*np.unravel_index(np.argsort(gap, axis=None, kind="stable"), gap.shape)):
        s, t = a.tiles[i], b.tiles[j]
        if gap[i, j] > max(a.dist[s].max(), b.dist[t].max()):
            continue
        of_a, of_b = a.reaches(s, b, j), b.reaches(t, a, i)
        n, m = s.stop - s.start, t.stop - t.start
        rows, cols = np.arange(s.start, s.stop), np.arange(t.start, t.stop)
        if len(of_a) * m + len(of_b) * n < 0.8 * n * m:
            # rows that ask against the whole other tile, then the other tile's that ask against the rest
            rest = np.delete(rows, of_a)
            parts = [(rows[of_a], cols), (rest, cols[of_b])]
        else:
            parts = [(rows, cols)]
        for r, c in parts:
            if len(r) and len(c):
                _compare(a, r, b, c)
                if compared is not None:
                    compared.add(len(r) * len(c))


def nearest_both_ways(src: DataFrame, tgt: DataFrame, feat: str = "fpfh", block_rows: int = 4_000, compared=None) -> DataFrame:
    """_NEAR: the exact nearest feature of the other side for every source (side
    0) and target row (side 1), ties to the smaller id; a row per group of the
    other side, the least of which is the answer.

    Both sides are dealt to groups, and every two groups meet in a task of their
    own, which cuts them to tiles of like features (at most ``block_rows`` rows) and
    rules out what is too far from a tile's box. A pair of rows is compared
    once for both directions. ``compared``, an accumulator, counts pairs."""
    spark = src.sparkSession
    if src.isEmpty() or tgt.isEmpty():
        return spark.createDataFrame([], _NEAR)
    centre, axes = _axes(tgt, feat)
    par = spark.sparkContext.defaultParallelism

    def groups(n: int) -> int:
        return max(math.ceil(n / (block_rows * BLOCKS_TOGETHER)), min(math.ceil(math.sqrt(2 * par)), math.ceil(n / LEAST_FEATURE_GROUP)))

    n_src, n_tgt = groups(src.count()), groups(tgt.count())
    sizes = [min(block_rows, t) for t in FEATURE_TILE]

    def packed(rows: DataFrame, n: int, own: str, other: str, others: int) -> DataFrame:
        """The rows of a group in each task's batch as one row, for every group of the other side."""
        def run(batches):
            for pdf in batches:
                ids = pdf["id"].to_numpy(np.int64)
                group = (((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(n)).astype(np.int64)
                x = np.stack(pdf["f"].to_numpy()).astype(np.float64) if len(pdf) else np.empty((0, 1))
                found = np.unique(group)
                yield pd.DataFrame({own: found.astype(np.int32), "ids": [ids[group == k].tobytes() for k in found], "f": [x[group == k].tobytes() for k in found]})

        rows = rows.select(F.col("pt_id").alias("id"), F.col(feat).alias("f")).mapInPandas(run, f"{own} int, ids binary, f binary")
        rows = rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        # a number of tasks that isn't made smaller: meeting is the work
        return rows.repartition(3 * n * others, "i", "j").groupBy("i", "j")

    def meet(ps: pd.DataFrame, pt: pd.DataFrame) -> pd.DataFrame:
        if ps.empty or pt.empty:
            return pd.DataFrame({c.split()[0]: [] for c in _NEAR.split(", ")})
        sides = []
        for p, size in zip((ps, pt), sizes):
            ids = np.frombuffer(b"".join(p["ids"]), np.int64)
            sides.append(_Side(ids, np.frombuffer(b"".join(p["f"])).reshape(len(ids), -1), centre, axes, size))
        _meet(*sides, compared)
        return pd.concat([pd.DataFrame({"side": np.int32(k), "id": s.ids, "other": s.other, "fdist": s.dist}) for k, s in enumerate(sides)])

    met = packed(src, n_src, "i", "j", n_tgt).cogroup(packed(tgt, n_tgt, "j", "i", n_src))
    return met.applyInPandas(meet, _NEAR).checkpoint()


def feature_nn(src: DataFrame, tgt: DataFrame, feat: str = "fpfh", block_rows: int = 4_000) -> DataFrame:
    """src_id, tgt_id, fdist: the exact nearest target feature of every source
    row (ties: smallest id)."""
    best = argmin_per_key(nearest_both_ways(src, tgt, feat, block_rows).filter("side = 0"), "id", "fdist", "other")
    return best.select(F.col("id").alias("src_id"), F.col("other").alias("tgt_id"), "fdist")


def mutual_matches(src_feat: DataFrame, tgt_feat: DataFrame, block_rows: int = 4_000, compared=None) -> DataFrame:
    """Pairs that are each other's nearest feature (C7, J8), from one pass."""
    best = argmin_per_key(nearest_both_ways(src_feat, tgt_feat, "fpfh", block_rows, compared), ["side", "id"], "fdist", "other").checkpoint()
    fwd = best.filter("side = 0").select(F.col("id").alias("src_id"), F.col("other").alias("tgt_id"), "fdist")
    bwd = best.filter("side = 1").select(F.col("other").alias("src_id"), F.col("id").alias("tgt_id"))
    return fwd.join(apart(bwd), ["src_id", "tgt_id"])


# --------------------------------------------------------------------------
# RANSAC on correspondences
# --------------------------------------------------------------------------

def rigid_fit(ps: np.ndarray, pt: np.ndarray) -> np.ndarray:
    """Least-squares rotation + translation mapping ps onto pt (Kabsch)."""
    cs, ct = ps.mean(0), pt.mean(0)
    h = (ps - cs).T @ (pt - ct)
    u, _, vt = np.linalg.svd(h)
    dfix = np.diag([1.0, 1.0, np.sign(np.linalg.det(vt.T @ u.T)) or 1.0])
    r = vt.T @ dfix @ u.T
    m = np.eye(4)
    m[:3, :3] = r
    m[:3, 3] = ct - r @ cs
    return m


def with_ordinal(df: DataFrame, key: str) -> DataFrame:
    """Contiguous 0-based ordinal by ``key`` without a single-partition sort."""
    from sitelens.operators.cluster import global_rank

    return global_rank(df, key).withColumnRenamed("_rank", "ord")


def rigid_fits(ps: np.ndarray, pt: np.ndarray) -> np.ndarray:
    """Kabsch fits of many point sets at once: (n, k, 3) onto (n, k, 3)."""
    cs, ct = ps.mean(1, keepdims=True), pt.mean(1, keepdims=True)
    u, _, vt = np.linalg.svd(np.einsum("nki,nkj->nij", ps - cs, pt - ct))
    v, ut = np.swapaxes(vt, 1, 2), np.swapaxes(u, 1, 2)
    fix = np.ones((len(ps), 3))
    fix[:, 2] = np.where(np.linalg.det(v @ ut) < 0, -1.0, 1.0)
    r = (v * fix[:, None, :]) @ ut
    return np.concatenate((r, ct.transpose(0, 2, 1) - r @ cs.transpose(0, 2, 1)), axis=2)


# Below this many matches their table (7 numbers a row) is broadcast to the
# hypotheses; beyond it they meet in shuffle joins.
BROADCAST_MATCHES = 200_000


def _hypotheses(m: DataFrame, n_m: int, lo: int, hi: int, edge_ratio: float, seed: int) -> DataFrame:
    """Hypotheses lo..hi of four distinct matches each whose edge lengths
    agree. Every match is tested as it joins, so few rows reach the last."""
    spark = m.sparkSession
    hyp = spark.range(lo, hi).withColumnRenamed("id", "h")
    for k in range(4):
        draw = F.concat_ws(":", F.col("h").cast("string"), F.lit(str(k)))
        hyp = hyp.withColumn(f"o{k}", F.pmod(hash32(draw, seed), F.lit(n_m)))
    for k in range(4):
        side = m.select(F.col("ord").alias(f"o{k}"), *[F.col(s + c).alias(f"{s}{c}{k}") for s in "st" for c in XYZ])
        hyp = hyp.join(F.broadcast(side) if n_m <= BROADCAST_MATCHES else apart(side), f"o{k}")
        for j in range(k):
            ds, dt = (F.sqrt(sum((F.pow(F.col(f"{s}{c}{j}") - F.col(f"{s}{c}{k}"), 2) for c in XYZ), F.lit(0.0))) for s in "st")
            hyp = hyp.filter((F.col(f"o{j}") != F.col(f"o{k}")) & (ds >= dt * edge_ratio) & (dt >= ds * edge_ratio))
    return hyp.select("h", *[f"{s}{c}{k}" for s in "st" for k in range(4) for c in XYZ])


def coarse_align(src: DataFrame, tgt: DataFrame, matches: DataFrame, max_corr: float, n_hyp: int = 4_000_000,
                 edge_ratio: float = 0.9, seed: int = 42, confidence: float = 0.999, batch: int = 100_000) -> dict:
    """RANSAC over 4-match hypotheses (C8): edge-length and distance checks,
    rigid fit, inliers = matches within ``max_corr`` after the transform.
    Best: most inliers, then smaller RMSE, then smaller hypothesis id.

    Hypotheses come in batches, at most ``n_hyp``. It stops early once four
    true matches would have been drawn with ``confidence``, given the best
    share of inliers so far. Coordinates are taken about the target's centre,
    so they may be map coordinates. Returns transform, fitness, inlier_rmse,
    n_matches, hypotheses; without a fit the identity with fitness 0."""
    spark = src.sparkSession
    origin = cloud_origin(tgt)
    m = (matches.join(apart(src.select(F.col("pt_id").alias("src_id"), *[(F.col(c) - o).alias("s" + c) for c, o in zip(XYZ, origin)])), "src_id")
         .join(apart(tgt.select(F.col("pt_id").alias("tgt_id"), *[(F.col(c) - o).alias("t" + c) for c, o in zip(XYZ, origin)])), "tgt_id"))
    m = with_ordinal(m, "src_id").checkpoint()
    n_m = m.count()
    best, done = None, 0

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf.drop(columns="h").to_numpy().reshape(-1, 2, 4, 3)
            ts = rigid_fits(x[:, 0], x[:, 1])
            moved = np.einsum("nij,nkj->nki", ts[:, :, :3], x[:, 0]) + ts[:, None, :, 3]
            ok = (np.linalg.norm(moved - x[:, 1], axis=2) <= max_corr).all(axis=1)
            out = pd.DataFrame(ts[ok].reshape(-1, 12), columns=[f"m{i}" for i in range(12)])
            out.insert(0, "h", pdf["h"].to_numpy()[ok])
            yield out

    while n_m >= 4 and done < n_hyp:
        hyp = _hypotheses(m, n_m, done, min(done + batch, n_hyp), edge_ratio, seed)
        done = min(done + batch, n_hyp)
        fits = hyp.mapInPandas(fit, "h long, " + ", ".join(f"m{i} double" for i in range(12))).toPandas()   # at most ``batch`` rows
        if len(fits):
            top = _count_inliers(m, fits["h"].to_numpy(), fits.drop(columns="h").to_numpy().reshape(-1, 3, 4), max_corr)
            if best is None or (top[0], -top[1]) > (best[0], -best[1]):
                best = top
        share = best[0] / n_m if best else 0.0
        if share > 0 and (share >= 1 or done >= math.log(1 - confidence) / math.log1p(-share ** 4)):
            break
    if best is None:
        return {"transform": np.eye(4).tolist(), "fitness": 0.0, "inlier_rmse": 0.0, "n_matches": n_m, "hypotheses": done}
    return {"transform": about(best[2], origin).tolist(), "fitness": best[0] / n_m, "inlier_rmse": best[1], "n_matches": n_m, "hypotheses": done}


COUNT_TILE = 128, 1_024     # hypotheses and matches that a task tries at a time


def _count_inliers(m: DataFrame, ids: np.ndarray, mats: np.ndarray, max_corr: float) -> tuple[int, float, np.ndarray]:
    """(inliers, rmse, local 4x4) of the best fitted hypothesis, in one pass
    over the matches."""
    bc = m.sparkSession.sparkContext.broadcast(mats)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ts = bc.value
        inl, sq = np.zeros(len(ts), np.int64), np.zeros(len(ts))
        for pdf in batches:
            ps, pt = (np.ascontiguousarray(pdf[[s + c for c in XYZ]].to_numpy(np.float64).T) for s in "st")
            for r, i in itertools.product(range(0, ps.shape[1], COUNT_TILE[1]), range(0, len(ts), COUNT_TILE[0])):
                rows, some = slice(r, r + COUNT_TILE[1]), slice(i, i + COUNT_TILE[0])
                d2 = 0.0
                for k in range(3):
                    gap = ts[some, k, :3] @ ps[:, rows] + ts[some, k, 3:] - pt[k, rows]
                    d2 = d2 + gap * gap
                hit = d2 <= max_corr * max_corr
                inl[some] += hit.sum(axis=1)
                sq[some] += np.where(hit, d2, 0.0).sum(axis=1)
        yield pd.DataFrame({"i": np.arange(len(ts)), "h": ids, "inl": inl, "sq": sq})

    r = (m.select(*[s + c for s in "st" for c in XYZ]).mapInPandas(count, "i long, h long, inl long, sq double")
         .groupBy("i", "h").agg(F.sum("inl").alias("inl"), F.sum("sq").alias("sq"))
         .withColumn("rmse", F.when(F.col("inl") > 0, F.sqrt(F.col("sq") / F.col("inl"))).otherwise(0.0))
         .orderBy(F.col("inl").desc(), F.col("rmse"), F.col("h")).first())
    t = np.eye(4)
    t[:3] = mats[r["i"]]
    return r["inl"], float(r["rmse"]), t


def cloud_origin(cloud: DataFrame) -> list[float]:
    """Whole-number coordinates near the cloud's centre (zeros if empty)."""
    row = cloud.agg(*[F.avg(c).alias(c) for c in XYZ]).first()
    return [float(math.floor(row[c])) if row[c] is not None else 0.0 for c in XYZ]


def about(local: np.ndarray, origin) -> np.ndarray:
    """The transform in world coordinates of one given about ``origin``."""
    shift = np.eye(4)
    shift[:3, 3] = origin
    return shift @ np.asarray(local) @ np.linalg.inv(shift)


def local_transform(world, origin) -> np.ndarray:
    """The inverse of ``about``."""
    shift = np.eye(4)
    shift[:3, 3] = origin
    return np.linalg.inv(shift) @ np.asarray(world) @ shift


# --------------------------------------------------------------------------
# Point-to-plane ICP
# --------------------------------------------------------------------------

def _small_transform(x: np.ndarray) -> np.ndarray:
    a, b, g = x[:3]
    ca, sa, cb, sb, cg, sg = math.cos(a), math.sin(a), math.cos(b), math.sin(b), math.cos(g), math.sin(g)
    r = np.array([[cg * cb, -sg * ca + cg * sb * sa, sg * sa + cg * sb * ca],
                  [sg * cb, cg * ca + sg * sb * sa, -cg * sa + sg * sb * ca],
                  [-sb, cb * sa, cb * ca]])
    t = np.eye(4)
    t[:3, :3] = r
    t[:3, 3] = x[3:]
    return t


# A round's equations: matches, their squared distances, the upper triangle of J'J, and J'r.
_UPPER = [(i, j) for i in range(6) for j in range(i, 6)]
_EQUATIONS = ["cnt", "sq", *[f"a{i}{j}" for i, j in _UPPER], *[f"b{i}" for i in range(6)]]

ICP_BLOCK = 8              # side of a block of points, in reaches (how far beside it its targets may lie)
ICP_SLACK = 2.0            # how far points may move within their blocks at first, in ``max_corr``
ICP_BLOCK_ROWS = 100_000   # points of blocks with more rows meet their targets in a join of cells, every round
ICP_GROUP_ROWS = 20_000    # rows of blocks that are packed together, on average
ICP_TASK_ROWS = 1_000_000  # rows that a task of a round passes over, on average
ICP_CELLS = 1 << 20        # cells along an axis that a key has room for
ICP_CANDIDATES = 500_000   # candidate pairs formed at a time
ICP_COLLECT_TASKS = 256    # sums of more tasks are added up by a shuffle
_G = [f"g{c}" for c in XYZ]


def _pair_equations(base: DataFrame, tq: DataFrame, t: np.ndarray, max_corr: float) -> np.ndarray:
    """The equations by a join of cells of side ``max_corr``: each source id's
    nearest target within it (in its own and the 26 neighbouring cells)."""
    def cell(c: str) -> Column:
        return F.floor(F.col(c) / F.lit(float(max_corr))).cast("long")

    steps = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(_G, off)]) for off in itertools.product((-1, 0, 1), repeat=3)])
    p, n = [F.col(a) for a in XYZ], [F.col(a) for a in ("nx", "ny", "nz")]
    q = [F.col("q" + a) for a in XYZ]
    sq = sum((F.pow(a - b, 2) for a, b in zip(p, q)), F.lit(0.0))
    r = sum(((a - b) * c for a, b, c in zip(p, q, n)), F.lit(0.0))
    jv = _cross(p, n) + n
    aggs = [F.count(F.lit(1)).alias("cnt"), F.sum("d2").alias("sq"), *[F.sum(jv[i] * jv[j]).alias(f"a{i}{j}") for i, j in _UPPER],
            *[F.sum(jv[i] * r).alias(f"b{i}") for i in range(6)]]
    moved = apply_transform(base, t.tolist())
    probe = moved.withColumn("_o", F.explode(steps)).select("pt_id", *XYZ, *[(cell(c) + F.col(f"_o.{k}")).alias(k) for k, c in zip(_G, XYZ)])
    near = (probe.join(apart(tq.withColumns({k: cell("q" + c) for k, c in zip(_G, XYZ)})), _G)
            .withColumn("d2", sq).filter(F.col("d2") <= float(max_corr) ** 2)
            .groupBy("pt_id").agg(F.min(F.struct("d2", "nn_id", *XYZ, *["q" + c for c in XYZ], "nx", "ny", "nz")).alias("m")))
    row = near.select("m.*").agg(*aggs).first()
    return np.array([row[k] or 0 for k in _EQUATIONS], np.float64)


def _cell_keys(cells: np.ndarray) -> np.ndarray:
    return (cells[:, 0] << 42) + (cells[:, 1] << 21) + cells[:, 2]


def _near_equations(p: np.ndarray, tgt: np.ndarray, keys: np.ndarray, order: np.ndarray, lo: np.ndarray, max_corr: float) -> np.ndarray:
    """The same of points ``p`` and targets ``tgt`` (position and normal, by id)
    of a group of blocks; ``keys``: the targets' cells from ``lo`` on, in order,
    ``order``: the targets in that order."""
    total = np.zeros(len(_EQUATIONS))
    cells = np.floor(p / max_corr) - lo
    asked = np.flatnonzero(((cells >= -1) & (cells <= ICP_CELLS)).all(axis=1))
    centre = _cell_keys(cells[asked].astype(np.int64))[:, None] + np.array([(i << 42) + (j << 21) for i in (-1, 0, 1) for j in (-1, 0, 1)])[None, :]
    first, last = np.searchsorted(keys, centre - 1, "left"), np.searchsorted(keys, centre + 1, "right")
    upto = np.cumsum((last - first).sum(axis=1))
    start = 0
    while start < len(asked):
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + ICP_CANDIDATES, "right")))
        n = (last[start:end] - first[start:end]).ravel()
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[start:end].ravel(), n)
        a, b = np.repeat(np.repeat(asked[start:end], 9), n), order[at]
        start = end
        gap = p[a] - tgt[b, :3]
        d2 = gap[:, 0] * gap[:, 0] + gap[:, 1] * gap[:, 1] + gap[:, 2] * gap[:, 2]
        hit = d2 <= max_corr ** 2
        a, b, d2 = a[hit], b[hit], d2[hit]
        if len(a):
            begin = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
            least = np.minimum.reduceat(d2, begin)
            b = np.minimum.reduceat(np.where(d2 == np.repeat(least, np.diff(np.r_[begin, len(a)])), b, len(tgt)), begin)
            at, normal = p[a[begin]], tgt[b, 3:]
            r = ((at - tgt[b, :3]) * normal).sum(axis=1)
            jv = np.hstack([np.cross(at, normal), normal])
            square = jv.T @ jv
            total += np.r_[len(least), least.sum(), [square[i] for i in _UPPER], jv.T @ r]
    return total


def _round_equations(batches: Iterator[pd.DataFrame], t: np.ndarray, lo: np.ndarray, max_corr: float) -> Iterator[pd.DataFrame]:
    """A task's equations of a round: its groups' points moved by ``t``."""
    total = np.zeros(len(_EQUATIONS))
    for pdf in batches:
        for src, tgt, keys, order in zip(pdf["src"], pdf["tgt"], pdf["keys"], pdf["order"]):
            x = np.frombuffer(src).reshape(-1, 3)
            p = np.stack([x[:, 0] * t[i, 0] + t[i, 3] + x[:, 1] * t[i, 1] + x[:, 2] * t[i, 2] for i in range(3)], axis=1)
            total += _near_equations(p, np.frombuffer(tgt).reshape(-1, 6), np.frombuffer(keys, np.int64), np.frombuffer(order, np.int64), lo, max_corr)
    yield pd.DataFrame([total], columns=_EQUATIONS)


class IcpRounds:
    """The equations of ICP's rounds. Source points are dealt to spatial blocks
    with the targets within reach, packed once, and a round passes over these:
    nothing is shuffled. That holds until a point may have moved by more than the
    blocks' slack (the corners of the source's box tell); then they are dealt
    again, with more slack. Points whose id repeats, or whose blocks hold more
    than ``ICP_BLOCK_ROWS`` rows, go by ``_pair_equations``; so do all where
    targets lack an id or a normal or span more than ``ICP_CELLS`` cells."""

    def __init__(self, base: DataFrame, tq: DataFrame, max_corr: float):
        self.max_corr, self.tq, self.loose, self.dense, self.packed = float(max_corr), tq, None, None, None
        self.alone = base.filter(" AND ".join(f"abs({c}) < double('infinity')" for c in XYZ))       # others are near nothing
        near = tq.filter(" AND ".join(f"abs(q{c}) < double('infinity')" for c in XYZ))
        whole = " AND ".join(["nn_id IS NOT NULL", *[f"abs(n{c}) < double('infinity')" for c in XYZ]])
        ends = near.agg(F.count_if(~F.coalesce(F.expr(whole), F.lit(False))).alias("bad"), F.count(F.lit(1)).alias("n"),
                        *[f("q" + c).alias(k + c) for c in XYZ for f, k in ((F.min, "lo"), (F.max, "hi"))]).first()
        box = self.alone.agg(*[f(c).alias(k + c) for c in XYZ for f, k in ((F.min, "lo"), (F.max, "hi"))]).first()
        if ends["n"] and box["lox"] is not None:
            self.lo = np.array([math.floor(ends["lo" + c] / self.max_corr) for c in XYZ], np.float64)
            if ends["bad"] or max(math.floor(ends["hi" + c] / self.max_corr) - o for c, o in zip(XYZ, self.lo)) >= ICP_CELLS - 2:
                self.loose, self.alone = base, None
                return
            self.lo -= 1        # targets' cells count from 1
            self.corners = np.array(list(itertools.product(*[(box["lo" + c], box["hi" + c]) for c in XYZ])))
            self.near, self.slack = near, ICP_SLACK * self.max_corr
            repeated = base.groupBy("pt_id").count().filter("count > 1").select(F.col("pt_id").alias("_again")).checkpoint()
            if not repeated.isEmpty():
                same = F.col("pt_id").eqNullSafe(F.col("_again"))
                self.loose = base.join(apart(repeated), same, "left_semi").checkpoint()
                self.alone = self.alone.join(apart(repeated), same, "left_anti").checkpoint()
        else:
            self.alone = None

    def _deal(self, t: np.ndarray) -> None:
        self.at, least = t, ICP_SLACK * self.max_corr
        moved = apply_transform(self.alone.withColumns({"_" + c: F.col(c) for c in XYZ}), t.tolist())
        while True:
            reach = self.max_corr + self.slack
            side = ICP_BLOCK * reach
            src = moved.select("pt_id", *[F.col("_" + c).alias(c) for c in XYZ], *[F.floor(F.col(c) / F.lit(side)).alias(g) for c, g in zip(XYZ, _G)])
            tgt = self.near
            for c, g in zip(XYZ, _G):
                # a little wider: the exact distance decides
                wide = F.lit(reach * (1 + 1e-6)) + F.abs(F.col("q" + c)) * F.lit(1e-9)
                tgt = tgt.withColumn(g, F.explode(F.sequence(F.floor((F.col("q" + c) - wide) / F.lit(side)), F.floor((F.col("q" + c) + wide) / F.lit(side)))))
            sizes = (src.groupBy(*_G).agg(F.count(F.lit(1)).alias("n"))
                     .join(apart(tgt.groupBy(*_G).agg(F.count(F.lit(1)).alias("m"))), _G).checkpoint())
            hot = sizes.filter(F.greatest("n", "m") > ICP_BLOCK_ROWS).select(*_G).checkpoint()
            if self.slack <= least or hot.isEmpty():
                break
            self.slack = max(self.slack / 2, least)
        self.dense = None
        if not hot.isEmpty():
            self.dense = src.join(apart(hot), _G, "left_semi").drop(*_G).checkpoint()
            src, tgt = (d.join(apart(hot), _G, "left_anti") for d in (src, tgt))
        rows = sizes.agg(F.sum(F.col("n") + F.col("m")).alias("rows")).first()["rows"] or 0
        par = src.sparkSession.sparkContext.defaultParallelism
        groups, lo, max_corr = max(8 * par, math.ceil(rows / ICP_GROUP_ROWS)), self.lo, self.max_corr
        group = F.pmod(F.xxhash64(*_G), F.lit(groups)).cast("int").alias("_t")

        def pack(ps: pd.DataFrame, pt: pd.DataFrame) -> pd.DataFrame:
            if ps.empty or pt.empty:
                return pd.DataFrame({c: [] for c in ("src", "tgt", "keys", "order")})
            columns = [*["q" + c for c in XYZ], "nx", "ny", "nz"]
            tgt = pt.sort_values(["nn_id", *columns], kind="stable").drop_duplicates(["nn_id", *columns])[columns].to_numpy(np.float64)
            keys = _cell_keys((np.floor(tgt[:, :3] / max_corr) - lo).astype(np.int64))
            order = np.argsort(keys, kind="stable")
            return pd.DataFrame({"src": [ps[XYZ].to_numpy(np.float64).tobytes()], "tgt": [tgt.tobytes()], "keys": [keys[order].tobytes()], "order": [order.tobytes()]})

        # a number of tasks that isn't made smaller: the rows are few, the search is the work
        src, tgt = (d.select("*", group).repartition(min(groups, 16 * par), "_t") for d in (src.select(*XYZ, *_G), tgt))
        packed = src.groupBy("_t").cogroup(tgt.groupBy("_t")).applyInPandas(pack, "src binary, tgt binary, keys binary, order binary")
        self.packed = packed.repartition(max(par, math.ceil(rows / ICP_TASK_ROWS))).checkpoint()

    def at_transform(self, t: np.ndarray) -> dict:
        """cnt, sq, a00 .. a55, b0 .. b5 of the source under ``t``."""
        total = np.zeros(len(_EQUATIONS))
        if self.alone is not None:
            drift = math.inf if self.packed is None else np.linalg.norm(self.corners @ (t - self.at)[:3, :3].T + (t - self.at)[:3, 3], axis=1).max()
            if drift * (1 + 1e-9) > self.slack:
                self.slack = self.slack if self.packed is None else max(self.slack, 2 * drift)
                self._deal(t)
            parts = self.packed.mapInPandas(functools.partial(_round_equations, t=t, lo=self.lo, max_corr=self.max_corr), ", ".join(f"{c} double" for c in _EQUATIONS))
            if self.packed.rdd.getNumPartitions() > ICP_COLLECT_TASKS:
                parts = parts.agg(*[F.sum(c).alias(c) for c in _EQUATIONS])
            total += parts.toArrow().to_pandas().to_numpy(np.float64).sum(axis=0)
        for rest in (self.loose, self.dense):
            if rest is not None:
                total += _pair_equations(rest, self.tq, t, self.max_corr)
        return dict(zip(_EQUATIONS, total.tolist()))


def icp_align(src: DataFrame, tgt_normals: DataFrame, max_corr: float, init=None, max_iter: int = 200,
              rel_tol: float = 1e-6) -> dict:
    """Point-to-plane ICP (C9). Each round moves the source, finds each point's
    nearest target within ``max_corr``, sums the 6x6 normal equations of the
    linearised residual (p - q).n (``IcpRounds``) and solves them on the driver.
    Coordinates are taken about the target's centre, so the equations stay
    well-conditioned anywhere. Stops when fitness and RMSE change by less than
    ``rel_tol`` (relative), or after ``max_iter`` rounds (``converged`` is then
    false)."""
    origin = cloud_origin(tgt_normals)
    t = local_transform(init if init is not None else np.eye(4), origin)
    tq = right_size(tgt_normals.select(F.col("pt_id").alias("nn_id"), *[(F.col(c) - o).alias("q" + c) for c, o in zip(XYZ, origin)], "nx", "ny", "nz"))
    base = right_size(src.select("pt_id", *[(F.col(c) - o).alias(c) for c, o in zip(XYZ, origin)]))
    n_src, rounds = base.count(), IcpRounds(base, tq, max_corr)
    prev, fitness, rmse, it, converged = None, 0.0, 0.0, 0, False
    for it in range(1, max_iter + 1):
        row = rounds.at_transform(t)
        cnt = row["cnt"]
        if cnt < 6:
            break
        fitness, rmse = cnt / n_src, math.sqrt(row["sq"] / cnt)
        if prev is not None and abs(prev[0] - fitness) <= rel_tol * max(prev[0], 1e-300) \
                and abs(prev[1] - rmse) <= max(rel_tol * prev[1], 1e-12):
            converged = True
            break
        prev = (fitness, rmse)
        a = np.zeros((6, 6))
        for i, j in _UPPER:
            a[i, j] = a[j, i] = row[f"a{i}{j}"]
        b = np.array([row[f"b{i}"] for i in range(6)])
        t = _small_transform(np.linalg.lstsq(a, -b, rcond=None)[0]) @ t
    return {"transform": about(t, origin).tolist(), "fitness": fitness, "inlier_rmse": rmse, "iterations": it, "converged": converged}
