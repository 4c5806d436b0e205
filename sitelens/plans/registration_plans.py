"""Registration plans (C5-C9, C11, C14): one uneven surface scanned twice.

The target is a bumpy surface over the part table at map coordinates, the
source the same points moved by a known rigid transform. The plans align the
source back; where a plan ends in the transform, its oracle states the known
inverse.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.operators import cloud as CL
from sitelens.operators import registration as RG
from sitelens.operators.spatial import apart
from sitelens.plans import common
from sitelens.sources.fixtures import read_table

VOXEL = 0.05
CENTER = (690_001.0, 3_630_001.0, 30.0)      # about which the known transform turns
ANGLE = 0.35
SHIFT = (0.3, -0.2, 0.1)
# source = T_LOCAL applied to the target, about CENTER
T_LOCAL = np.array([[math.cos(ANGLE), -math.sin(ANGLE), 0.0, SHIFT[0]],
                    [math.sin(ANGLE), math.cos(ANGLE), 0.0, SHIFT[1]],
                    [0.0, 0.0, 1.0, SHIFT[2]],
                    [0.0, 0.0, 0.0, 1.0]])
EXPECTED = np.linalg.inv(T_LOCAL)
COARSE_TOLERANCE = 0.1


def surface(spark: SparkSession, sf: str) -> DataFrame:
    """A jittered grid, 2 m wide, under waves that don't repeat in it."""
    k = F.col("p_partkey")
    x = (k % 50) * F.lit(0.04) + ((k * 7919) % 1000) * F.lit(0.00002)
    y = F.floor(k / F.lit(50.0)) * F.lit(0.04) + ((k * 104729) % 1000) * F.lit(0.00002)
    flat = read_table(spark, sf, "part").select(k.alias("pt_id"), x.alias("x"), y.alias("y"))
    z = (0.16 * F.sin(3.1 * F.col("x") + 0.7 * F.col("y")) + 0.12 * F.sin(1.9 * F.col("y") - 2.3 * F.col("x") + 0.4)
         + 0.07 * F.sin(4.3 * F.col("x") * F.col("y") + 1.1) + 0.05 * F.cos(6.1 * F.col("y")))
    return flat.select("pt_id", *[(c + F.lit(o - 1.0 if i < 2 else o)).alias(n) for i, (c, o, n) in
                                  enumerate(zip((F.col("x"), F.col("y"), z), CENTER, CL.XYZ))])


def downsample(cloud: DataFrame, voxel: float = VOXEL) -> DataFrame:
    v = CL.voxel_downsample(cloud, voxel)
    return v.select(F.xxhash64("vx", "vy", "vz").alias("pt_id"), *CL.XYZ)


def prepared(cloud: DataFrame, voxel: float = VOXEL) -> DataFrame:
    """Voxel grid, normals (2v, 30), FPFH (5v, 100): the preprocessing step."""
    down = downsample(cloud, voxel).checkpoint()
    normals = CL.estimate_normals(down, 2 * voxel, 30).checkpoint()
    return normals.join(apart(RG.fpfh_features(normals, 5 * voxel, 100)), "pt_id").checkpoint()


def pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    tgt = surface(spark, sf)
    return CL.apply_transform(tgt, RG.about(T_LOCAL, CENTER).tolist()), tgt


def align(src: DataFrame, tgt: DataFrame, voxel: float = VOXEL) -> tuple[dict, dict]:
    """Coarse alignment of the downsampled clouds by their features, then ICP
    of the full clouds from its result."""
    ps, pt = prepared(src, voxel), prepared(tgt, voxel)
    coarse = RG.coarse_align(ps, pt, RG.mutual_matches(ps, pt), max_corr=1.5 * voxel)
    return coarse, fine_align(src, tgt, coarse["transform"], voxel)


def fine_align(src: DataFrame, tgt: DataFrame, init, voxel: float = VOXEL) -> dict:
    """ICP of the full clouds: correspondences within 0.4 voxel, 200 rounds."""
    return RG.icp_align(src, CL.estimate_normals(tgt, 2 * voxel, 30), max_corr=0.4 * voxel, init=init, max_iter=200)


def q_normals(spark, sf):
    """Normals of the scan at map coordinates, by their angle to those of the
    same points near the origin."""
    tgt = surface(spark, sf)
    near = CL.apply_transform(tgt, [[1, 0, 0, -CENTER[0]], [0, 1, 0, -CENTER[1]], [0, 0, 1, -CENTER[2]], [0, 0, 0, 1]])
    a = CL.estimate_normals(tgt, 2 * VOXEL, 30).select("pt_id", "nx", "ny", "nz")
    b = CL.estimate_normals(near, 2 * VOXEL, 30).select("pt_id", *[F.col(c).alias("o" + c) for c in ("nx", "ny", "nz")])
    dot = sum((F.col(c) * F.col("o" + c) for c in ("nx", "ny", "nz")), F.lit(0.0))
    return a.join(apart(b), "pt_id").select("pt_id", (F.abs(dot) > 1 - 1e-9).alias("same_direction"))


def q_fpfh_features(spark, sf):
    return prepared(common.cloud_source(spark, sf)).select("pt_id", "fpfh")


def q_feature_matches(spark, sf):
    src, tgt = pair(spark, sf)
    return RG.mutual_matches(prepared(src), prepared(tgt))


def _entries(world) -> list[tuple[str, float]]:
    """The transform's entries about CENTER, three decimals."""
    local = RG.local_transform(world, CENTER)
    return [(f"t{i}{j}", round(float(local[i, j]), 3) + 0.0) for i in range(3) for j in range(4)]


def q_coarse_align(spark, sf):
    src, tgt = pair(spark, sf)
    ps, pt = prepared(src), prepared(tgt)
    res = RG.coarse_align(ps, pt, RG.mutual_matches(ps, pt), max_corr=1.5 * VOXEL)
    error = float(np.abs(RG.local_transform(res["transform"], CENTER) - EXPECTED).max())
    return spark.createDataFrame([(error < COARSE_TOLERANCE,)], "recovered boolean")


def q_icp_align(spark, sf):
    """From a start that is off by a few millimetres and milliradians."""
    src, tgt = pair(spark, sf)
    off = RG._small_transform(np.array([0.004, -0.003, 0.005, 0.004, -0.005, 0.003]))
    res = fine_align(src, tgt, RG.about(off @ EXPECTED, CENTER))
    return spark.createDataFrame(_entries(res["transform"]) + [("fitness", round(res["fitness"], 3))], "name string, value double")


def q_register_chain(spark, sf):
    """Preprocess, coarse, fine, transform, deviation: the whole chain."""
    src, tgt = pair(spark, sf)
    _, fine = align(src, tgt)
    moved = CL.apply_transform(src, fine["transform"]).checkpoint()
    report = CL.deviation_report(CL.cloud_distance(moved, tgt))
    stats = report.agg(F.avg("deviation_m").alias("mean"), F.count(F.when(F.col("alert"), 1)).alias("alerts")).first()
    rows = _entries(fine["transform"]) + [("fitness", round(fine["fitness"], 3)), ("mean_deviation", round(stats["mean"], 3) + 0.0),
                                          ("alerts", float(stats["alerts"]))]
    return spark.createDataFrame(rows, "name string, value double")


def _expected_sql(*more: tuple[str, float]) -> str:
    rows = [(f"t{i}{j}", round(float(EXPECTED[i, j]), 3) + 0.0) for i in range(3) for j in range(4)] + list(more)
    return "SELECT * FROM (VALUES " + ", ".join(f"('{n}', {v!r}::DOUBLE)" for n, v in rows) + ") t(name, value)"


def register_all() -> None:
    from sitelens.plans.registry import add
    add("normals", q_normals, "SELECT p_partkey AS pt_id, true AS same_direction FROM part")
    add("fpfh_features", q_fpfh_features)
    add("feature_matches", q_feature_matches)
    add("coarse_align", q_coarse_align, "SELECT true AS recovered")
    add("icp_align", q_icp_align, _expected_sql(("fitness", 1.0)))
    add("register_chain", q_register_chain, _expected_sql(("fitness", 1.0), ("mean_deviation", 0.0), ("alerts", 0.0)))


register_all()
