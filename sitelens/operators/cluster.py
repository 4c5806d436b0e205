"""Clustering (M1-M13): split, scaling, centroid models, k-means, Euclidean
silhouette, DBSCAN, Ward and cluster labels.

Driver-side state is limited to fitted parameters whose size is set by
arguments, never by rows: scaler means/deviations (one per feature),
centroids (k x features), silhouette anchors (``sample_rows`` x features),
Ward micro-centroids (``micro`` x features).
"""

from __future__ import annotations

import functools
import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitelens.functions.hashing import TWO_32, hash32, unit_hash
from sitelens.operators.spatial import DEFAULT_ROWS_PER_SPLIT, _offsets, apart, right_size, split_hot_cells, spread

def _debug(msg: str) -> None:
    import os
    import sys
    import time
    if os.environ.get("SITELENS_DEBUG"):
        print(f"[sitelens {time.strftime('%H:%M:%S')}] {msg}", file=sys.stderr, flush=True)


# Feature lists of the venue model and of the regional model.
FEATURE_COLS = ["price_nis", "rating", "reviews_count"]
REGION_FEATURE_COLS = ["price_nis", "rating", "lat", "lng"]


# k-means stops on its tolerance; this only bounds a run that doesn't.
KMEANS_MAX_ITER = 300
# A fixpoint: no centre moves farther than this along an axis of scaled features.
KMEANS_TOLERANCE = 1e-9
LLOYD_COLLECT_TASKS = 256
# Rows near a border between centres that a pass brings to the driver, per model, whatever the input.
SHELL_ROWS = 10_000

# --------------------------------------------------------------------------
# M1 split, M2 scaling
# --------------------------------------------------------------------------

def split_train_test(df: DataFrame, id_col: str = "row_id", test_fraction: float = 0.30,
                     seed: int = 42) -> DataFrame:
    """Adds ``split`` = 'train'/'test' from a seeded hash of the id (M1).

    Each row decides alone, so the split is the same for any partitioning
    and any strata (a stratified split is the same rule applied per stratum).
    """
    u = unit_hash(id_col, seed)
    return df.withColumn("split", F.when(u < F.lit(1.0 - test_fraction), F.lit("train")).otherwise(F.lit("test")))


def split_exact(df: DataFrame, id_col: str = "row_id", test_fraction: float = 0.30, seed: int = 42,
                strata: Sequence[str] = ()) -> DataFrame:
    """Adds ``split`` with exactly ceil(test_fraction * n) test rows of every
    stratum (of the whole table without ``strata``), repeatable for any layout:
    the rows with the largest seeded hashes, ties by id (M1). Rows are ranked
    by a distributed sort, so no task holds a stratum; null stratum values
    form a stratum."""
    keys = [f"_s{i}" for i in range(len(strata))]
    d = df.withColumns({**{k: F.col(c) for k, c in zip(keys, strata)}, "_one": F.lit(0)})
    d = d.withColumn("_order", F.struct(*keys, hash32(id_col, seed).alias("h"), F.col(id_col).alias("id")))
    ranked = global_rank(d, "_order").drop("_order")
    sizes = ranked.groupBy("_one", *keys).agg(F.min("_rank").alias("_lo"), F.count(F.lit(1)).alias("_n")).checkpoint()
    sizes = sizes.withColumnsRenamed({k: k + "g" for k in [*keys, "_one"]})
    same = [F.col(k).eqNullSafe(F.col(k + "g")) for k in [*keys, "_one"]]
    out = ranked.join(F.broadcast(sizes) if sizes.count() <= 100_000 else sizes, same)
    test = F.col("_rank") - F.col("_lo") >= F.col("_n") - F.ceil(F.col("_n") * F.lit(test_fraction))
    return out.withColumn("split", F.when(test, F.lit("test")).otherwise(F.lit("train"))).select(*df.columns, "split")


@dataclass
class Scaler:
    """Standard scaling with the population deviation; constant column -> 1."""
    cols: list[str]
    means: list[float]
    stds: list[float]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], fill_zero: bool = True) -> "Scaler":
        cols = list(cols)
        src = [F.coalesce(F.col(c), F.lit(0.0)) if fill_zero else F.col(c) for c in cols]
        row = df.agg(*[F.avg(s).alias(f"m{i}") for i, s in enumerate(src)],
                     *[F.stddev_pop(s).alias(f"s{i}") for i, s in enumerate(src)]).first()
        means = [float(row[f"m{i}"]) if row[f"m{i}"] is not None else 0.0 for i in range(len(cols))]
        stds = []
        for i in range(len(cols)):
            s = row[f"s{i}"]
            stds.append(1.0 if s is None or s == 0.0 else float(s))
        return cls(cols, means, stds)

    def z_cols(self, prefix: str = "z_") -> list[str]:
        return [prefix + c for c in self.cols]

    def transform(self, df: DataFrame, prefix: str = "z_", fill_zero: bool = True) -> DataFrame:
        return df.withColumns({
            prefix + c: ((F.coalesce(F.col(c), F.lit(0.0)) if fill_zero else F.col(c)) - F.lit(m)) / F.lit(s)
            for c, m, s in zip(self.cols, self.means, self.stds)})

    def inverse(self, centers: np.ndarray) -> np.ndarray:
        return np.asarray(centers) * np.asarray(self.stds) + np.asarray(self.means)


# --------------------------------------------------------------------------
# Centroid models (M3, M3b) and k-means
# --------------------------------------------------------------------------

def nearest_center(cols: Sequence[str], centers: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest centre (squared Euclidean), ties to the smallest
    index: the min of (distance, index) structs, a pure JVM expression."""
    cands = []
    for j, c in enumerate(centers):
        d = None
        for col, v in zip(cols, c):
            t = (F.col(col) - F.lit(float(v))) * (F.col(col) - F.lit(float(v)))
            d = t if d is None else d + t
        cands.append(F.struct(d.alias("d"), F.lit(j).alias("j")))
    return F.array_min(F.array(*cands))["j"]


@dataclass
class CentroidModel:
    """Scaler + centres in scaled space; predicts a ``cluster`` column.
    ``info`` holds what belongs to the fit (labels by cluster, scores, the k
    sweep) and is saved with it."""
    scaler: Scaler
    centers: list[list[float]]
    algorithm: str = "KMeans"
    info: dict = field(default_factory=dict)

    @property
    def k(self) -> int:
        return len(self.centers)

    def predict(self, df: DataFrame, out: str = "cluster") -> DataFrame:
        z = self.scaler.transform(df, prefix="_z_")
        return z.withColumn(out, nearest_center(self.scaler.z_cols("_z_"), self.centers)).drop(
            *self.scaler.z_cols("_z_"))

    def centers_original(self) -> np.ndarray:
        return self.scaler.inverse(np.asarray(self.centers))

    def centroid_frame(self, spark: SparkSession) -> DataFrame:
        """cluster + centre in original units, one row per cluster (k rows)."""
        orig = self.centers_original()
        rows = [(j, *[float(v) for v in orig[j]]) for j in range(self.k)]
        return spark.createDataFrame(rows, ["cluster", *self.scaler.cols])

    # Save / load -------------------------------------------------------
    def save(self, spark: SparkSession, path: str) -> None:
        meta = {"algorithm": self.algorithm, "cols": self.scaler.cols, "means": self.scaler.means,
                "stds": self.scaler.stds, "centers": self.centers, "info": self.info}
        spark.createDataFrame([(json.dumps(meta),)], ["model"]).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "CentroidModel | None":
        from sitelens.sources.io import _exists

        row = spark.read.parquet(path).first() if _exists(spark, path) else None
        if row is None:
            return None
        m = json.loads(row["model"])
        return cls(Scaler(m["cols"], m["means"], m["stds"]), m["centers"], m["algorithm"], m.get("info", {}))


def seeded_centers(df: DataFrame, z_cols: Sequence[str], k: int, id_col: str, seed: int = 42) -> list[list[float]]:
    """k rows with the smallest seeded hash as starting centres (Forgy)."""
    rows = df.orderBy(hash32(id_col, seed), F.col(id_col)).limit(k).select(*z_cols).collect()
    return [[float(r[c]) for c in z_cols] for r in rows]


def race_centers(z: DataFrame, z_cols: Sequence[str], k: int, id_col: str, seed: int = 42) -> list[list[float]]:
    """k-means++ start: the row with the smallest seeded hash, then k - 1 times a
    row drawn with a chance in proportion to its squared distance to the centres
    so far. The draw is a race of exponential clocks: the smallest
    -ln(u) / distance wins, u a seeded hash of the row and the turn, so it is
    the same on any layout and the start for k begins that for k + 1.
    Fewer centres where there are fewer distinct rows."""
    centers: list[list[float]] = []
    for j in range(k):
        h = hash32(id_col, f"{seed}:{j}")
        if centers:
            gaps = [_sq(z_cols, c) for c in centers]
            gap = F.least(*gaps) if len(gaps) > 1 else gaps[0]
            key = F.when(gap > 0, -F.log((h + 1) / F.lit(TWO_32 + 1)) / gap)
        else:
            key = h.cast("double")
        win = z.select(F.struct(key.alias("key"), F.col(id_col).alias("id"), *z_cols).alias("s")).filter("s.key IS NOT NULL").agg(F.min("s").alias("s")).first()["s"]
        if win is None:
            break
        centers.append([float(win[c]) for c in z_cols])
    return centers


def _sq(cols: Sequence[str], center: Sequence[float]) -> Column:
    total = None
    for c, v in zip(cols, center):
        t = (F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v)))
        total = t if total is None else total + t
    return total


def lloyd(z: DataFrame, z_cols: Sequence[str], starts: dict[int, list[list[float]]], max_iter: int = KMEANS_MAX_ITER,
          tolerance: float = KMEANS_TOLERANCE, shell_rows: int = SHELL_ROWS) -> dict[int, tuple[list[list[float]], int, bool]]:
    """k-means steps (assign, grouped mean) from each of ``starts`` until no
    centre moves by more than ``tolerance`` along an axis: (centres, steps,
    converged) per key. One pass over ``z`` serves all that still move; a
    centre without rows stays.

    A row whose nearest centre leads by a gap keeps it until the centres have
    moved by half of that. So a pass brings its sums and, apart from them, up to
    ``shell_rows`` rows of the smallest gaps, and as many steps as the centres stay
    within half of the least gap left behind are taken with these rows alone. The
    steps are those of plain k-means; the last ones, which move little, share passes."""
    found = {k: (c, 0, False) for k, c in starts.items()}
    rows = z.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(z_cols)])
    sums = [f"s{i}" for i in range(len(z_cols))]
    schema = "k int, j int, row long, n long, gap double, " + ", ".join(f"{s} double" for s in sums)
    # sums of few tasks come to the driver as they are (a row per task and centre), others are added up by a shuffle
    tasks = rows.rdd.getNumPartitions()
    while True:
        # models of equal centres (fewer distinct rows than k) and those at rest aren't moved
        moving = {k: np.array(f[0]) for k, f in found.items() if not f[2] and len(f[0]) and f[1] < max_iter}
        if not moving:
            break
        # the centres travel with the function, not in the plan, so no step compiles new code
        parts = rows.mapInPandas(functools.partial(_step_sums, centers=moving, most=shell_rows // max(1, tasks)), schema)
        if tasks > LLOYD_COLLECT_TASKS:
            parts = parts.groupBy("k", "j", "row").agg(F.sum("n").alias("n"), F.min("gap").alias("gap"), *[F.sum(s).alias(s) for s in sums])
        got = parts.toArrow().to_pandas()
        for k in moving:
            found[k] = _steps(got[got["k"] == k], sums, *found[k][:2], max_iter, tolerance)
    return found


def _steps(got: pd.DataFrame, sums: list[str], centers: list[list[float]], step: int, max_iter: int,
           tolerance: float) -> tuple[list[list[float]], int, bool]:
    """The steps that a pass allows: (centres, steps taken in all, converged)."""
    apart_ = got["row"] >= 0
    known, shell = got[~apart_], [np.ascontiguousarray(v) for v in got.loc[apart_, sums].to_numpy(np.float64).T]
    settled = np.zeros((len(centers), len(sums) + 1))
    np.add.at(settled, known["j"].to_numpy(), known[["n", *sums]].to_numpy(np.float64))
    gap, began = known["gap"].min() if len(known) else np.inf, np.array(centers)
    while True:
        total = settled + _sums_by_center(shell, _nearest(shell, np.array(centers))[0], len(centers))
        new = [[float(v) for v in t[1:] / t[0]] if t[0] else c for t, c in zip(total, centers)]
        moved = max((abs(a - b) for x, y in zip(centers, new) for a, b in zip(x, y)), default=0.0)
        centers, step = new, step + 1
        drift = np.sqrt(((np.array(centers) - began) ** 2).sum(axis=1)).max()
        if moved <= tolerance or step >= max_iter or not 2 * drift * (1 + 1e-9) + 1e-12 * (1 + np.abs(began).max()) < gap:
            return centers, step, moved <= tolerance


def _nearest(x: list[np.ndarray], centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest centre (rows ``x``: an axis an array) and by how much it
    is nearer than the next."""
    # centre by centre: no table of rows times centres, the first of equal distances wins
    near, least, second = np.zeros(len(x[0]), np.int64), np.full(len(x[0]), np.inf), np.full(len(x[0]), np.inf)
    for j, at in enumerate(centers):
        square = (x[0] - at[0]) ** 2
        for i in range(1, len(x)):
            square += (x[i] - at[i]) ** 2
        near[square < least] = j
        np.minimum(second, np.maximum(least, square), out=second)
        np.minimum(least, square, out=least)
    with np.errstate(invalid="ignore"):     # a row at an infinite distance from all has no gap
        return near, np.sqrt(second) - np.sqrt(least)


def _sums_by_center(x: list[np.ndarray], near: np.ndarray, k: int) -> np.ndarray:
    """Number and sums of the rows per centre."""
    return np.column_stack([np.bincount(near, minlength=k), *[np.bincount(near, weights=v, minlength=k) for v in x]])


def _step_sums(batches: Iterator[pd.DataFrame], centers: dict[int, np.ndarray], most: int = 0) -> Iterator[pd.DataFrame]:
    """A task's rows per model and nearest centre: their number and sums
    (``row`` -1), with the least gap among them, and apart from these up to ``most`` rows
    of the smallest gaps."""
    total = {k: np.zeros((len(c), c.shape[1] + 1)) for k, c in centers.items()}
    shell = {k: np.zeros((c.shape[1] + 2, 0)) for k, c in centers.items()}      # gap, nearest centre, coordinates
    gap = {k: np.inf if most else 0.0 for k in centers}     # those left behind lead by this at least
    for pdf in batches:
        x = [np.ascontiguousarray(c) for c in pdf.to_numpy(np.float64).T]
        for k, c in centers.items():
            near, lead = _nearest(x, c)
            few = lead < gap[k]
            total[k] += _sums_by_center([v[~few] for v in x], near[~few], len(c))
            part = np.hstack([shell[k], np.vstack([lead[few], near[few], *[v[few] for v in x]])])
            if part.shape[1] > most:
                part = part[:, np.argpartition(part[0], most)]
                gap[k], rest, part = min(gap[k], part[0, most]), part[1:, most:], part[:, :most]
                total[k] += _sums_by_center(list(rest[1:]), rest[0].astype(np.int64), len(c))
            shell[k] = part
    context = TaskContext.get()
    task = context.partitionId() if context else 0
    for k, t in total.items():
        j = shell[k][1].astype(np.int64)
        kept = np.flatnonzero(t[:, 0])
        out = np.vstack([t[kept, 1:], shell[k][2:].T])
        yield pd.DataFrame({"k": np.int32(k), "j": np.r_[kept, j].astype(np.int32), "row": np.r_[np.full(len(kept), -1), (task << 32) + np.arange(len(j))],
                            "n": np.r_[t[kept, 0], np.ones(len(j))].astype(np.int64), "gap": np.r_[np.full(len(kept), gap[k]), shell[k][0]],
                            **{f"s{i}": out[:, i] for i in range(out.shape[1])}})


def kmeans_fit(train: DataFrame, cols: Sequence[str], k: int, seed: int = 42, scaler: Scaler | None = None,
               max_iter: int = KMEANS_MAX_ITER, id_col: str | None = None, start: list[list[float]] | None = None) -> CentroidModel:
    """k-means on scaled features (M3): a k-means++ start drawn by seeded
    hashes, then Lloyd steps to the fixpoint, so the model is the same on any
    layout. ``info`` holds the steps taken and whether they converged before
    ``max_iter``. Empty training data gives a model without centres. ``id_col``
    is row_id where there is one, else pt_id. ``start``: scaled centres to step from
    instead, such as a sweep's for the same rows, which are at rest already."""
    id_col = id_col or ("row_id" if "row_id" in train.columns else "pt_id")
    scaler = scaler or Scaler.fit(train, cols)
    z = right_size(scaler.transform(train).select(id_col, *scaler.z_cols()))
    start = race_centers(z, scaler.z_cols(), k, id_col, seed) if start is None else start
    centers, steps, converged = lloyd(z, scaler.z_cols(), {k: start}, max_iter)[k]
    return CentroidModel(scaler, centers, algorithm="KMeans", info={"iterations": steps, "converged": converged})


# --------------------------------------------------------------------------
# M5 Euclidean silhouette, exact or sampled as the caller says
# --------------------------------------------------------------------------

_SUMS = "which int, anchor long, own long, cluster long, dsum double, cnt long"
TILE = 128, 512       # anchors and rows whose distances a task holds at a time: they stay in its cache
MOST_MEETINGS = 2_000  # tasks that pairs of blocks are dealt to


class _Rows:
    """A block's rows, those of equal labels together, with a slot for every
    label of every labelling. ``order`` tells where the rows came from."""

    def __init__(self, x: np.ndarray, labels: np.ndarray):
        self.slots: list[tuple[int, int]] = []
        one = []
        for which in range(labels.shape[1]):
            found, at = np.unique(labels[:, which], return_inverse=True)
            one.append(np.eye(len(found))[at])
            self.slots += [(which, int(c)) for c in found]
        hot = np.hstack(one)
        self.counts = hot.sum(axis=0).astype(np.int64)
        # rows of equal labels stand together and are added up before they meet the clusters
        alike = np.unique(labels, axis=0, return_inverse=True)[1].ravel()
        self.order = np.argsort(alike, kind="stable")
        self.x, self._alike, self._mixed = np.ascontiguousarray(x[self.order].T), alike[self.order], hot[self.order]

    def tiles(self, size: int) -> list[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """(place, rows, starts of the runs of equal labels, the slots of each
        run). Long runs have tiles of their own: adding up one run is cheaper."""
        change = np.flatnonzero(np.r_[True, self._alike[1:] != self._alike[:-1]])
        cuts = range(0, len(self._alike), size)
        if len(change) * size <= len(self._alike):
            cuts = [s for lo, hi in zip(change, np.r_[change[1:], len(self._alike)]) for s in range(lo, hi, size)]
        out = []
        for lo, hi in zip(cuts, [*cuts[1:], len(self._alike)]):
            starts = change[(change > lo) & (change < hi)] - lo
            starts = np.r_[0, starts]
            out.append((slice(lo, hi), np.ascontiguousarray(self.x[:, lo:hi]), starts, self._mixed[lo + starts]))
        return out


def _distances(a: np.ndarray, b: np.ndarray, out: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """The distances between the points ``a`` and ``b`` (an axis a row), in ``out``."""
    shape = a.shape[1], b.shape[1]      # without holes, so that numpy goes through it in one loop
    out, gap = (x.reshape(-1)[:shape[0] * shape[1]].reshape(shape) for x in (out, gap))
    np.subtract(a[0][:, None], b[0], out=out)
    np.multiply(out, out, out=out)
    for j in range(1, len(a)):
        np.subtract(a[j][:, None], b[j], out=gap)
        np.multiply(gap, gap, out=gap)
        np.add(out, gap, out=out)
    return np.sqrt(out, out=out)


class _DistanceSums:
    """Per labelling, anchor and cluster: the sum of the distances from the
    anchor to the cluster's rows, and their number, over any number of blocks
    of rows. Distances are formed once for all labellings."""

    def __init__(self, ids: np.ndarray, own: np.ndarray, at: np.ndarray):
        self.ids, self.own, self.at = ids, own, at
        self.sums: dict[tuple[int, int], np.ndarray] = {}
        self.counts: dict[tuple[int, int], int] = {}

    def add(self, x: np.ndarray, labels: np.ndarray) -> None:
        """Rows ``x`` with a column of ``labels`` per labelling."""
        rows = _Rows(x, labels)
        anchors = np.ascontiguousarray(self.at.T)
        total = np.zeros((len(self.at), len(rows.slots)))
        out, gap = np.empty(TILE), np.empty(TILE)
        for _, part, starts, to in rows.tiles(TILE[1]):
            for r in range(0, len(self.at), TILE[0]):
                d = _distances(anchors[:, r:r + TILE[0]], part, out, gap)
                total[r:r + TILE[0]] += (d.sum(axis=1, keepdims=True) if len(starts) == 1 else np.add.reduceat(d, starts, axis=1)) @ to
        self._take(rows, total)

    def meet(self, other: "_DistanceSums") -> None:
        """The anchors of both are rows of the other: a distance is formed once
        and counts for both."""
        a, b = _Rows(self.at, self.own), _Rows(other.at, other.own)
        of_a, of_b = np.zeros((len(a.order), len(b.slots))), np.zeros((len(b.order), len(a.slots)))
        out, gap = np.empty(TILE), np.empty(TILE)
        a_tiles = a.tiles(TILE[0])
        for s, part, b_starts, b_to in b.tiles(TILE[1]):
            for r, own, a_starts, a_to in a_tiles:
                d = _distances(own, part, out, gap)
                of_a[r] += (d.sum(axis=1, keepdims=True) if len(b_starts) == 1 else np.add.reduceat(d, b_starts, axis=1)) @ b_to
                of_b[s] += (d.sum(axis=0, keepdims=True) if len(a_starts) == 1 else np.add.reduceat(d, a_starts, axis=0)).T @ a_to
        for sums, mine, theirs, total in ((self, a, b, of_a), (other, b, a, of_b)):
            back = np.empty_like(total)
            back[mine.order] = total
            sums._take(theirs, back)

    def _take(self, rows: _Rows, total: np.ndarray) -> None:
        for i, (slot, n) in enumerate(zip(rows.slots, rows.counts)):
            self.sums[slot] = self.sums.get(slot, 0.0) + total[:, i]
            self.counts[slot] = self.counts.get(slot, 0) + int(n)

    def rows(self) -> Iterator[pd.DataFrame]:
        for (which, c), d in self.sums.items():
            yield pd.DataFrame({"which": np.int32(which), "anchor": self.ids, "own": self.own[:, which], "cluster": np.int64(c), "dsum": d,
                                "cnt": np.int64(self.counts[which, c])})


# A block of rows has at most so many sums (rows x clusters) in a task.
BLOCK_SUMS = 4_000_000
# Blocks are not cut below this many rows to keep the cores busy.
LEAST_BLOCK = 2_500


def _blocks(rows: int, clusters: int, block_rows: int, cores: int) -> int:
    """How many blocks ``rows`` are dealt to: at most about ``block_rows`` rows
    in each, fewer where there are many clusters, and some twenty pairs of blocks
    for every core, which even out."""
    most = max(1, min(block_rows, BLOCK_SUMS // max(1, clusters)))
    busy = min(math.ceil(rows / LEAST_BLOCK), math.ceil(math.sqrt(40 * cores)))
    return max(1, math.ceil(rows / most), busy)


def _exact_sums(data: DataFrame, cols: list[str], labels: list[str], block_rows: int) -> DataFrame:
    """All rows against all rows in blocks: two blocks meet in a task of their
    own, once, and the distances count for the rows of both, so no task or
    driver holds more than two blocks. Work is rows x rows / 2, which the exact
    value needs."""
    rows, *clusters = data.agg(F.count(F.lit(1)), *[F.count_distinct(c) for c in labels]).first()
    n = _blocks(rows, sum(clusters), block_rows, data.sparkSession.sparkContext.defaultParallelism)
    chunk = F.pmod(F.xxhash64("_id"), F.lit(n)).cast("int")
    left = data.withColumn("i", chunk).withColumn("j", F.explode(F.sequence(F.col("i"), F.lit(n - 1))))
    right = data.withColumn("j", chunk).filter("j > 0").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("j") - 1)))
    # a number of tasks that isn't made smaller: the blocks are small, their meeting is the work
    tasks = min(n * (n + 1) // 2, MOST_MEETINGS)
    left, right = left.repartition(tasks, "i", "j"), right.repartition(tasks, "i", "j")

    def meet(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        one, two = (_DistanceSums(d["_id"].to_numpy(), d[labels].to_numpy(), d[cols].to_numpy(np.float64)) for d in (a, b))
        if key[0] == key[1]:
            one.add(one.at, one.own)
        elif len(a) and len(b):
            one.meet(two)
        out = [*one.rows(), *two.rows()]
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in _SUMS.split(", ")})

    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(meet, _SUMS)


def _sampled_sums(data: DataFrame, cols: list[str], labels: list[str], anchors: pd.DataFrame) -> DataFrame:
    """The anchors against all rows; the anchors are broadcast, their number
    is a parameter. A task adds up all its rows and tells its sums once."""
    bc = data.sparkSession.sparkContext.broadcast((anchors["_id"].to_numpy(), anchors[labels].to_numpy(), anchors[cols].to_numpy(np.float64)))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = _DistanceSums(*bc.value)
        for pdf in batches:
            if len(pdf):
                sums.add(pdf[cols].to_numpy(np.float64), pdf[labels].to_numpy())
        yield from sums.rows()

    return data.mapInPandas(partial, _SUMS)


def silhouettes(df: DataFrame, cols: Sequence[str], cluster_cols: Sequence[str], id_col: str, method: str = "exact",
                sample_rows: int = 10_000, seed: int = 42, block_rows: int = 40_000) -> DataFrame:
    """Mean silhouette with Euclidean distance (not ``ClusteringEvaluator``'s
    squared distance) of several labellings of the same rows, one row each:
    which (position in ``cluster_cols``), silhouette, n_anchors, method, stderr.

    The caller names the method, the number of rows never does. ``exact``
    compares all rows with all rows in blocks on the executors. ``sampled``
    averages over the ``sample_rows`` rows with the smallest seeded hash
    against all rows (an unbiased estimate; ``stderr`` is its standard error).
    A row alone in its cluster, or with no distance to anything, counts 0."""
    if method not in ("exact", "sampled"):
        raise ValueError(f"unknown silhouette method {method!r}")
    from sitelens.operators.ranking import sample_rows as _sample

    fs, ls = [f"_f{i}" for i in range(len(cols))], [f"_c{i}" for i in range(len(cluster_cols))]
    data = df.select(F.col(id_col).alias("_id"), *[F.col(c).cast("long").alias(x) for c, x in zip(cluster_cols, ls)],
                     *[F.col(c).cast("double").alias(f) for c, f in zip(cols, fs)])
    if method == "exact":
        sums = _exact_sums(data.checkpoint(), fs, ls, block_rows)
    else:
        data = right_size(data)
        sums = _sampled_sums(data, fs, ls, _sample(data, sample_rows, id_col="_id", seed=seed).toPandas())
    sums = sums.groupBy("which", "anchor", "own", "cluster").agg(F.sum("dsum").alias("dsum"), F.sum("cnt").alias("cnt"))
    mine = F.col("cluster") == F.col("own")
    per = sums.groupBy("which", "anchor").agg(F.max(F.when(mine, F.col("cnt"))).alias("n_own"), F.max(F.when(mine, F.col("dsum"))).alias("d_own"),
                                              F.min(F.when(~mine, F.col("dsum") / F.col("cnt"))).alias("b"))
    a = F.col("d_own") / (F.col("n_own") - 1)
    s = (F.when((F.col("n_own") <= 1) | F.col("b").isNull(), F.lit(0.0)).when(F.greatest(a, F.col("b")) == 0, F.lit(0.0))
         .otherwise((F.col("b") - a) / F.greatest(a, F.col("b"))))
    stderr = F.stddev_samp("s") / F.sqrt(F.count(F.lit(1)))
    return per.select("which", s.alias("s")).groupBy("which").agg(
        F.avg("s").alias("silhouette"), F.count(F.lit(1)).alias("n_anchors"), F.lit(method).alias("method"),
        (F.lit(0.0) if method == "exact" else stderr).alias("stderr"))


def silhouette(df: DataFrame, cols: Sequence[str], cluster_col: str, id_col: str, method: str = "exact",
               sample_rows: int = 10_000, seed: int = 42, block_rows: int = 40_000) -> DataFrame:
    """The mean silhouette of one labelling, one row (see ``silhouettes``)."""
    return silhouettes(df, cols, [cluster_col], id_col, method, sample_rows, seed, block_rows).drop("which")


def silhouette_squared(df: DataFrame, cols: Sequence[str], cluster_col: str) -> float:
    """Silhouette with *squared* Euclidean distance (M5b's scale option):
    Spark ML's ``ClusteringEvaluator``, which needs only per-cluster sums, so
    it is linear in rows. It is a different number from the Euclidean
    silhouette of ``silhouette`` and is reported under its own name."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler

    vec = (VectorAssembler(inputCols=list(cols), outputCol="_f").transform(df)
           .withColumn("_p", F.col(cluster_col).cast("double")))
    ev = ClusteringEvaluator(featuresCol="_f", predictionCol="_p", metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(vec))


class Score(NamedTuple):
    """A silhouette with how it came about."""
    value: float
    method: str
    anchors: int
    stderr: float | None


def silhouette_values(df: DataFrame, cols: Sequence[str], cluster_cols: Sequence[str], id_col: str, method: str = "sampled",
                      sample_rows: int = 10_000) -> list[Score]:
    """Silhouettes of several labellings of the same rows, their distances
    formed once; fewer than two clusters -> 0.0 (D9)."""
    ends = df.agg(*[f(F.col(c)).alias(n + str(i)) for i, c in enumerate(cluster_cols) for f, n in ((F.min, "lo"), (F.max, "hi"))],
                  *[F.count_if(F.col(c).isNull()).alias(f"none{i}") for i, c in enumerate(cluster_cols)]).first()
    several = [c for i, c in enumerate(cluster_cols)
               if ends[f"lo{i}"] != ends[f"hi{i}"] or (ends[f"none{i}"] and ends[f"lo{i}"] is not None)]
    found = {several[r["which"]]: Score(float(r["silhouette"] or 0.0), r["method"], r["n_anchors"], r["stderr"])
             for r in (silhouettes(df, cols, several, id_col, method, sample_rows).collect() if several else [])}
    return [found.get(c, Score(0.0, method, 0, None)) for c in cluster_cols]


def silhouette_value(df: DataFrame, cols: Sequence[str], cluster_col: str, id_col: str, method: str = "sampled",
                     sample_rows: int = 10_000) -> Score:
    """Silhouette as a number with its method, anchors and standard error (see ``silhouette_values``)."""
    return silhouette_values(df, cols, [cluster_col], id_col, method, sample_rows)[0]


def k_sweep(train_z: DataFrame, z_cols: Sequence[str], id_col: str, ks: Sequence[int] = range(3, 9),
            seed: int = 42, method: str = "sampled", sample_rows: int = 10_000,
            max_iter: int = KMEANS_MAX_ITER) -> tuple[int, list[tuple[int, Score]]]:
    """Fit k-means for each k and score by the named silhouette; first best k
    wins (M4). All k share the start, the passes of their steps and the
    distances of their scores."""
    return k_sweep_models(train_z, z_cols, id_col, ks, seed, method, sample_rows, max_iter)[:2]


def k_sweep_models(train_z: DataFrame, z_cols: Sequence[str], id_col: str, ks: Sequence[int] = range(3, 9),
                   seed: int = 42, method: str = "sampled", sample_rows: int = 10_000,
                   max_iter: int = KMEANS_MAX_ITER) -> tuple[int, list[tuple[int, Score]], dict[int, list[list[float]]]]:
    """``k_sweep`` with the centres it found for every k."""
    z = right_size(train_z.select(id_col, *z_cols))
    ks = list(ks)
    start = race_centers(z, z_cols, max(ks), id_col, seed)
    models = lloyd(z, z_cols, {k: start[:k] for k in ks}, max_iter)
    names = [f"_k{k}" for k in ks]
    labelled = z.withColumns({n: nearest_center(z_cols, models[k][0]) if models[k][0] else F.lit(0) for n, k in zip(names, ks)})
    found = {r["which"]: r for r in silhouettes(labelled, z_cols, names, id_col, method, sample_rows, seed).collect()}
    scores = []
    for i, k in enumerate(ks):
        r = found.get(i)
        scores.append((k, Score(float(r["silhouette"] or 0.0), r["method"], r["n_anchors"], r["stderr"]) if r else Score(0.0, method, 0, None)))
    best = max(scores, key=lambda t: (t[1].value, -t[0]))[0]
    return best, scores, {k: models[k][0] for k in ks}


# --------------------------------------------------------------------------
# M6 DBSCAN
# --------------------------------------------------------------------------

def global_rank(df: DataFrame, col: str) -> DataFrame:
    """0-based rank of ``col`` over the whole table without a one-task
    window: range-partition (frozen by a checkpoint so every later read
    sees the same partitions), count rows per partition (one row each),
    offset each partition by the counts before it, number rows within it."""
    par = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))
    parts = df.repartitionByRange(par, col).withColumn("_pid", F.spark_partition_id()).checkpoint()
    sizes = parts.groupBy("_pid").agg(F.count(F.lit(1)).alias("_sz"))
    offs = sizes.withColumn("_off", F.coalesce(
        F.sum("_sz").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rn = F.row_number().over(Window.partitionBy("_pid").orderBy(col)) - 1
    return (parts.join(F.broadcast(offs.select("_pid", "_off")), "_pid")
            .withColumn("_rank", F.col("_off") + rn).drop("_pid", "_off"))


def connected_components(edges: DataFrame, nodes: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """Smallest node id of each node's component: min-label propagation plus
    pointer jumping (label := label of label). Both halves of a round are
    checkpointed to the shared checkpoint folder, so a round's plan starts at
    written tables, however many there were before: the driver holds no chain of
    plans and a lost executor recomputes little. Raises rather than return unfinished
    labels after ``max_rounds``. ``edges``: (src, dst), any
    direction; ``nodes``: (node). Output: node, comp."""
    e = edges.select(F.col("src"), F.col("dst"))
    # the edge list is read every round: materialise it once
    both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct().checkpoint()
    labels = nodes.select("node", F.col("node").alias("comp")).checkpoint()
    for r in range(max_rounds):
        nb = (both.join(apart(labels.withColumnRenamed("node", "dst")), "dst")
              .groupBy(F.col("src").alias("node")).agg(F.min("comp").alias("nc")))
        step = (labels.join(apart(nb), "node", "left")
                .select("node", F.col("comp").alias("old"), F.least(F.col("comp"), F.coalesce(F.col("nc"), F.col("comp"))).alias("comp"))).checkpoint()
        # pointer jumping
        to = step.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        jump = (step.join(apart(to), "comp", "left")
                .select("node", "old", F.least(F.col("comp"), F.coalesce(F.col("next"), F.col("comp"))).alias("comp"))).checkpoint()
        changed = not jump.filter(F.col("comp") != F.col("old")).isEmpty()
        labels = jump.drop("old")
        _debug(f"components round {r} changed={changed}")
        if not changed:
            return labels
    raise RuntimeError(f"components still changing after {max_rounds} rounds")


def _cross_cell_pairs(probe: DataFrame, build: DataFrame, offsets: list[list[int]], d: int, eps: float,
                      rows_per_split: int, probe_keep: Sequence[str] = (), build_keep: Sequence[str] = ()) -> DataFrame:
    """Pairs (a, b) within eps whose cells differ by one of ``offsets``.
    Inputs carry ``_id``, ``_x{i}``, ``_g{i}``. Only the probe side is
    exploded; hot build cells are salted."""
    gk = [f"_g{i}" for i in range(d)]
    off_arr = F.array(*[F.array(*[F.lit(v) for v in o]) for o in offsets])
    p = (probe.withColumn("_off", F.explode(off_arr))
         .select(F.col("_id").alias("a"), *[F.col(f"_x{i}").alias(f"a_x{i}") for i in range(d)],
                 *[(F.col(f"_g{i}") + F.col("_off")[i]).alias(f"_g{i}") for i in range(d)], *probe_keep))
    b = build.select(F.col("_id").alias("b"), *[F.col(f"_x{i}").alias(f"b_x{i}") for i in range(d)], *gk,
                     *build_keep)
    b, p, keys = split_hot_cells(b, p, gk, "b", rows_per_split)
    sq = None
    for i in range(d):
        t = (F.col(f"a_x{i}") - F.col(f"b_x{i}")) * (F.col(f"a_x{i}") - F.col(f"b_x{i}"))
        sq = t if sq is None else sq + t
    return p.join(apart(b), keys).filter(sq <= F.lit(float(eps) ** 2))


def dbscan(points: DataFrame, cols: Sequence[str], eps: float = 0.5, min_samples: int = 5,
           id_col: str = "pt_id", rows_per_split: int = DEFAULT_ROWS_PER_SPLIT) -> DataFrame:
    """DBSCAN (M6) with the scan-order numbering of the usual library.

    Grid of side eps/sqrt(d): two points of one cell are always neighbours.
    So (1) every point of a cell holding >= min_samples points is core with
    no pair work at all, and only points of sparse cells get their degree
    counted from neighbour pairs; (2) all core points of a cell share one
    graph node, and core-core links between cells are reduced on the fly to
    distinct (cell, cell) edges by a map-side-combined aggregate, so no pair
    table is ever materialised and a dense cell never emits its all-pairs;
    (3) components run on the cell graph (min-label propagation with pointer
    jumping). Clusters are numbered by their smallest core id; a border
    point takes the lowest cluster number among its core neighbours; noise
    is -1. Output: ``id_col``, ``cluster`` (int), ``is_core``.
    """
    cols = list(cols)
    d = len(cols)
    side = eps / math.sqrt(d) * (1.0 - 1e-12)   # in-cell distance stays <= eps under rounding
    reach = int(math.ceil(eps / side))
    gk = [f"_g{i}" for i in range(d)]
    xcols = [f"_x{i}" for i in range(d)]
    pts0 = points.select(F.col(id_col).alias("_id"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)])
    # Copies at identical coordinates become one representative (smallest
    # id) with a weight: they share degree, core flag and label, and a copy
    # group holding a third of the table then costs one row in every pair
    # step instead of one row per copy. The aggregate combines map-side.
    reps = pts0.groupBy(*xcols).agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_w"))
    pts = spread(reps.withColumns({f"_g{i}": F.floor(F.col(f"_x{i}") / F.lit(side)).cast("long") for i in range(d)}))
    cell_n = pts.groupBy(*gk).agg(F.sum("_w").alias("_cell_n"))
    pts_n = pts.join(apart(cell_n), gk)

    def min_gap(o):
        return math.sqrt(sum(max(abs(v) - 1, 0) ** 2 for v in o)) * side
    offs = [o for o in _offsets(d, reach) if any(o) and min_gap(o) <= eps]
    half = [o for o in offs if next(v for v in o if v != 0) > 0]

    # (1) degrees only where the cell count does not settle it
    sparse = pts_n.filter(F.col("_cell_n") < min_samples)
    deg_x = (_cross_cell_pairs(sparse, pts, offs, d, eps, rows_per_split, build_keep=[F.col("_w")])
             .groupBy(F.col("a").alias("_id")).agg(F.sum("_w").alias("_deg_x")))
    info = (pts_n.join(apart(deg_x), "_id", "left")
            .withColumn("is_core", (F.col("_cell_n") + F.coalesce(F.col("_deg_x"), F.lit(0))) >= min_samples)
            .select("_id", *[f"_x{i}" for i in range(d)], *gk, "is_core")).checkpoint()
    core = info.filter("is_core")
    cell_node = core.groupBy(*gk).agg(F.min("_id").alias("node")).checkpoint()
    core_n = core.join(apart(cell_node), gk).select("_id", *[f"_x{i}" for i in range(d)], *gk, "node").checkpoint()

    # (2) cell graph. (a) Sure links without point pairs: on sub-cells of
    # half the side, two occupied core sub-cells whose farthest corners are
    # within eps link their cells (decided on distinct sub-cells, not on
    # points). (b) Components over the sure links. (c) Point pairs only
    # between neighbouring cells still in different components (true
    # cluster boundaries), so two dense adjacent cells never form all pairs.
    ss = side / 2.0
    hk = [f"_h{i}" for i in range(d)]
    core_sub = core_n.select("node", *[F.floor(F.col(f"_x{i}") / F.lit(ss)).cast("long").alias(f"_h{i}")
                                       for i in range(d)]).distinct()
    sure_offs = [o for o in _offsets(d, 2 * reach) if any(o) and next(v for v in o if v != 0) > 0
                 and math.sqrt(sum((abs(v) + 1) ** 2 for v in o)) * ss <= eps]
    sure_arr = F.array(*[F.array(*[F.lit(v) for v in o]) for o in sure_offs])
    sure = (core_sub.withColumn("_off", F.explode(sure_arr))
            .select(F.col("node").alias("src"), *[(F.col(f"_h{i}") + F.col("_off")[i]).alias(f"_h{i}") for i in range(d)])
            .join(apart(core_sub.withColumnRenamed("node", "dst")), hk)
            .filter(F.col("src") != F.col("dst")).select("src", "dst").distinct())
    comps1 = connected_components(sure, cell_node.select("node"))
    cell_comp = cell_node.join(apart(comps1), "node")
    off_half = F.array(*[F.array(*[F.lit(v) for v in o]) for o in half])
    allowed = (cell_comp.withColumn("_off", F.explode(off_half))
               .select(F.col("node").alias("node_a"), F.col("comp").alias("comp_a"),
                       *[(F.col(f"_g{i}") + F.col("_off")[i]).alias(f"_g{i}") for i in range(d)])
               .join(apart(cell_comp.select(*gk, F.col("comp").alias("comp_b"))), gk)
               .filter(F.col("comp_a") != F.col("comp_b")))
    probe = (core_n.select(F.col("_id").alias("a"), *[F.col(f"_x{i}").alias(f"a_x{i}") for i in range(d)],
                           F.col("node").alias("node_a"))
             .join(apart(allowed), "node_a"))
    build = core_n.join(apart(comps1), "node").select(F.col("_id").alias("b"),
                                               *[F.col(f"_x{i}").alias(f"b_x{i}") for i in range(d)], *gk)
    build, probe, keys = split_hot_cells(build, probe, gk, "b", rows_per_split)
    sq = None
    for i in range(d):
        t = (F.col(f"a_x{i}") - F.col(f"b_x{i}")) * (F.col(f"a_x{i}") - F.col(f"b_x{i}"))
        sq = t if sq is None else sq + t
    links = (probe.join(apart(build), keys).filter(sq <= F.lit(float(eps) ** 2))
             .select(F.col("comp_a").alias("src"), F.col("comp_b").alias("dst")).distinct())
    _debug("dbscan: core flags done")
    links = links.checkpoint()
    if links.isEmpty():
        comps = comps1
    else:
        comps2 = connected_components(links, comps1.select(F.col("comp").alias("node")).distinct())
        comps = (comps1.join(apart(comps2.select(F.col("node").alias("comp"), F.col("comp").alias("final"))), "comp")
                 .select("node", F.col("final").alias("comp")))
    _debug("dbscan: components done")
    numbering = global_rank(comps.select("comp").distinct(), "comp").withColumn("cluster", F.col("_rank").cast("int")).drop("_rank")
    node_cluster = comps.join(apart(numbering), "comp").select("node", "cluster").checkpoint()
    core_cluster = core_n.select("_id", "node").join(apart(node_cluster), "node").select("_id", "cluster")

    # (3) border points: lowest cluster among core neighbours (same cell or across)
    non_core = info.filter(~F.col("is_core"))
    cell_cluster = cell_node.join(apart(node_cluster), "node").select(*gk, F.col("cluster").alias("cand"))
    same_cell = non_core.join(apart(cell_cluster), gk).select("_id", "cand")
    core_cl = core_n.join(apart(node_cluster), "node")
    across = (_cross_cell_pairs(non_core, core_cl, offs, d, eps, rows_per_split, build_keep=[F.col("cluster")])
              .select(F.col("a").alias("_id"), F.col("cluster").alias("cand")))
    border = same_cell.unionByName(across).groupBy("_id").agg(F.min("cand").alias("border_cluster"))
    rep_label = (info.select("_id", *xcols, "is_core").join(apart(core_cluster), "_id", "left").join(apart(border), "_id", "left")
                 .select(*xcols, F.coalesce(F.col("cluster"), F.col("border_cluster"), F.lit(-1)).cast("int").alias("cluster"),
                         "is_core"))
    # every copy takes its representative's label
    return pts0.join(apart(rep_label), xcols).select(F.col("_id").alias(id_col), "cluster", "is_core")


# --------------------------------------------------------------------------
# M8 Ward (micro-clusters on Spark, weighted Ward on the driver)
# --------------------------------------------------------------------------

def weighted_ward(centers: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """Ward merges of weighted points down to k groups; returns group per point.
    Merge cost n_i n_j / (n_i + n_j) * |c_i - c_j|^2. Size is ``micro`` points."""
    m = len(centers)
    c = centers.astype(np.float64).copy()
    w = weights.astype(np.float64).copy()
    alive = np.ones(m, dtype=bool)
    group = np.arange(m)
    members = {i: [i] for i in range(m)}
    while alive.sum() > k:
        idx = np.flatnonzero(alive)
        cc, ww = c[idx], w[idx]
        d2 = ((cc[:, None, :] - cc[None, :, :]) ** 2).sum(-1)
        cost = (ww[:, None] * ww[None, :]) / (ww[:, None] + ww[None, :]) * d2
        np.fill_diagonal(cost, np.inf)
        flat = int(np.argmin(cost))
        i, j = idx[flat // len(idx)], idx[flat % len(idx)]
        i, j = min(i, j), max(i, j)
        c[i] = (w[i] * c[i] + w[j] * c[j]) / (w[i] + w[j])
        w[i] += w[j]
        alive[j] = False
        members[i] += members.pop(j)
    roots = sorted(members, key=lambda r: min(members[r]))
    for g, r in enumerate(roots):
        for p in members[r]:
            group[p] = g
    return group


def ward_micro(train_z: DataFrame, z_cols: Sequence[str], k: int, micro: int = 256,
                 seed: int = 42, id_col: str = "row_id") -> tuple[DataFrame, dict]:
    """Micro-cluster Ward (M8), an approximation at every size: k-means into
    ``micro`` micro-clusters on Spark, weighted Ward on their centres on the
    driver (``micro`` rows, a parameter), map back with a ``micro``-row lookup.
    ``info`` names the method and ``micro``."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    spark = train_z.sparkSession
    vec = VectorAssembler(inputCols=list(z_cols), outputCol="_features").transform(train_z)
    n = vec.count()
    vec = right_size(vec, n).cache()
    m = int(min(micro, n))
    km = KMeans(k=m, seed=seed, featuresCol="_features", predictionCol="_micro", maxIter=KMEANS_MAX_ITER).fit(vec)
    assigned = km.transform(vec)
    w = assigned.groupBy("_micro").agg(F.count(F.lit(1)).alias("w")).collect()
    weights = np.zeros(m)
    for r in w:
        weights[r["_micro"]] = r["w"]
    centers = np.asarray(km.clusterCenters())
    used = np.flatnonzero(weights > 0)
    groups = weighted_ward(centers[used], weights[used], min(k, len(used)))
    lookup = spark.createDataFrame([(int(u), int(g)) for u, g in zip(used, groups)], "_micro int, cluster int")
    out = assigned.join(F.broadcast(lookup), "_micro").drop("_micro", "_features")
    return out, {"micro": m, "method": "ward_micro"}


# --------------------------------------------------------------------------
# M11 / M13 labels
# --------------------------------------------------------------------------

def cluster_labels(centroids: DataFrame, thresholds: dict, area_col: str | None = None) -> DataFrame:
    """'<Good|Average|Below Average> & <Expensive|Reasonable|Affordable>'
    from centre rating/price against the 33rd/67th percentiles (>=), with
    ' — <sub-area>' for regional models. A repeated base label gets
    ' (₪<price rounded half-even>)'; a second clash also gets the cluster id.

    ``centroids``: cluster, price_nis, rating[, area_col] (k rows)."""
    r, p = F.col("rating"), F.col("price_nis")
    rl = (F.when(r >= F.lit(thresholds["rating_67"]), "Good")
          .when(r >= F.lit(thresholds["rating_33"]), "Average").otherwise("Below Average"))
    pl = (F.when(p >= F.lit(thresholds["price_67"]), "Expensive")
          .when(p >= F.lit(thresholds["price_33"]), "Reasonable").otherwise("Affordable"))
    base = F.concat(rl, F.lit(" & "), pl)
    if area_col:
        base = F.concat(base, F.lit(" — "), F.col(area_col))
    w = Window.partitionBy("base_label").orderBy("cluster")
    price_txt = F.bround(p, 0).cast("long").cast("string")
    out = (centroids.withColumn("base_label", base)
           .withColumn("_n", F.row_number().over(w))
           .withColumn("label", F.when(F.col("_n") == 1, F.col("base_label"))
                       .otherwise(F.concat(F.col("base_label"), F.lit(" (₪"), price_txt, F.lit(")")))))
    w2 = Window.partitionBy("label").orderBy("cluster")
    return (out.withColumn("_m", F.row_number().over(w2))
            .withColumn("label", F.when(F.col("_m") == 1, F.col("label"))
                        .otherwise(F.concat(F.col("label"), F.lit(" #"), F.col("cluster").cast("string"))))
            .drop("_n", "_m"))
