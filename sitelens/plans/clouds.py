"""Point-cloud plans (section 2.8) with oracles: sampling, voxels, transforms,
cloud/mesh distances, deviation report and dashboard data."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.hashing import hash32_sql
from sitelens.operators import cloud as CL
from sitelens.operators import profile as P
from sitelens.operators.ranking import sample_rows
from sitelens.plans import common
from sitelens.plans.explore import histogram_sql
from sitelens.plans.registry import add
from sitelens.sources.fixtures import with_views

THRESHOLD = 0.05        # alert threshold, metres
MAX_COLOR_DIST = 0.2    # distance shown as full red
VOXEL = 0.05
ANGLE = 0.1             # rotation about z for the transform plan (radians)
SHIFT = (0.05, -0.02, 0.01)
TRANSFORM = [[math.cos(ANGLE), -math.sin(ANGLE), 0.0, SHIFT[0]],
             [math.sin(ANGLE), math.cos(ANGLE), 0.0, SHIFT[1]],
             [0.0, 0.0, 1.0, SHIFT[2]],
             [0.0, 0.0, 0.0, 1.0]]


def r6(c: str) -> F.Column:
    return F.round(F.col(c), 6).alias(c)


def _report(spark, sf) -> DataFrame:
    d = CL.cloud_distance(common.cloud_source(spark, sf), common.cloud_target(spark, sf))
    return CL.deviation_report(d, THRESHOLD, MAX_COLOR_DIST)


# SQL: nearest target for every source point (ties -> smallest target id)
NN_CTE = """nn AS (SELECT pt_id, x, y, z, nn_id, sqrt(sq) AS deviation_m FROM (
  SELECT s.pt_id, s.x, s.y, s.z, t.pt_id AS nn_id,
    (s.x - t.x) * (s.x - t.x) + (s.y - t.y) * (s.y - t.y) + (s.z - t.z) * (s.z - t.z) AS sq,
    row_number() OVER (PARTITION BY s.pt_id ORDER BY (s.x - t.x) * (s.x - t.x) + (s.y - t.y) * (s.y - t.y) + (s.z - t.z) * (s.z - t.z), t.pt_id) AS rn
  FROM cloud_source s, cloud_target t) u WHERE rn = 1)"""
REPORT_CTE = f"""{NN_CTE},
rep AS (SELECT pt_id, x, y, z, deviation_m, deviation_m > {THRESHOLD} AS alert,
  least(greatest(deviation_m / {MAX_COLOR_DIST}, 0.0E0), 1.0E0) AS r,
  1.0E0 - least(greatest(deviation_m / {MAX_COLOR_DIST}, 0.0E0), 1.0E0) AS g, 0.0E0 AS b FROM nn)"""


def q_cloud_sample(spark, sf):
    return CL.cloud_sample(common.cloud_source(spark, sf), 1000).select("pt_id", "x", "y", "z")


CLOUD_SAMPLE_SQL = with_views(f"SELECT pt_id, x, y, z FROM cloud_source ORDER BY {hash32_sql('pt_id')}, pt_id LIMIT 1000",
                              "cloud_source")


def q_voxel_downsample(spark, sf):
    v = CL.voxel_downsample(common.cloud_source(spark, sf), VOXEL)
    # means of coordinates on a 0.0005 lattice sit on 6-decimal half-way
    # points, so they are compared at 9 decimals
    return v.select("vx", "vy", "vz", *[F.round(a, 9).alias(a) for a in "xyz"], "n_points")


VOXEL_SQL = with_views(f""", lo AS (SELECT min(x) AS lx, min(y) AS ly, min(z) AS lz FROM cloud_source),
g AS (SELECT CAST(floor((x - (lx - {VOXEL} / 2)) / {VOXEL}) AS BIGINT) AS vx, CAST(floor((y - (ly - {VOXEL} / 2)) / {VOXEL}) AS BIGINT) AS vy,
  CAST(floor((z - (lz - {VOXEL} / 2)) / {VOXEL}) AS BIGINT) AS vz, x, y, z FROM cloud_source, lo)
SELECT vx, vy, vz, round(avg(x), 9) AS x, round(avg(y), 9) AS y, round(avg(z), 9) AS z, count(*) AS n_points
FROM g GROUP BY vx, vy, vz""", "cloud_source")


def q_apply_transform(spark, sf):
    t = CL.apply_transform(common.cloud_source(spark, sf), TRANSFORM)
    return t.select("pt_id", r6("x"), r6("y"), r6("z"))


def _tx_sql(i: int) -> str:
    m = TRANSFORM[i]
    return f"((x * {m[0]!r} + {m[3]!r}) + y * {m[1]!r}) + z * {m[2]!r}"


TRANSFORM_SQL = with_views(f"""SELECT pt_id, round({_tx_sql(0)}, 6) AS x, round({_tx_sql(1)}, 6) AS y,
  round({_tx_sql(2)}, 6) AS z FROM cloud_source""", "cloud_source")


def q_cloud_distance(spark, sf):
    d = CL.cloud_distance(common.cloud_source(spark, sf), common.cloud_target(spark, sf))
    return d.select("pt_id", "nn_id", r6("deviation_m"))


CLOUD_DIST_SQL = with_views(f", {NN_CTE}\nSELECT pt_id, nn_id, round(deviation_m, 6) AS deviation_m FROM nn",
                            "cloud_source", "cloud_target")


def q_deviation_report(spark, sf):
    return _report(spark, sf).select("pt_id", "x", "y", "z", r6("deviation_m"), "alert", r6("r"), r6("g"), "b")


REPORT_SQL = with_views(f""", {REPORT_CTE}
SELECT pt_id, x, y, z, round(deviation_m, 6) AS deviation_m, alert, round(r, 6) AS r, round(g, 6) AS g, b FROM rep""",
                        "cloud_source", "cloud_target")


def q_deviation_color(spark, sf):
    return _report(spark, sf).select("pt_id", r6("r"), r6("g"), "b")


COLOR_SQL = with_views(f", {REPORT_CTE}\nSELECT pt_id, round(r, 6) AS r, round(g, 6) AS g, b FROM rep",
                       "cloud_source", "cloud_target")


def q_deviation_stats(spark, sf):
    s = P.deviation_stats(_report(spark, sf), THRESHOLD)
    return s.select("n_points", r6("mean_dev"), r6("max_dev"), "n_alert", r6("pct_alert"))


STATS_SQL = with_views(f""", {REPORT_CTE}
SELECT count(*) AS n_points, round(avg(deviation_m), 6) AS mean_dev, round(max(deviation_m), 6) AS max_dev,
  count(CASE WHEN deviation_m > {THRESHOLD} THEN 1 END) AS n_alert,
  round(avg(CASE WHEN deviation_m > {THRESHOLD} THEN 1.0E0 ELSE 0.0E0 END) * 100, 6) AS pct_alert FROM rep""",
                       "cloud_source", "cloud_target")


def q_deviation_histogram(spark, sf):
    h = P.histogram(_report(spark, sf), "deviation_m", 80)
    return h.select("bin", r6("bin_lo"), r6("bin_hi"), "count")


DEV_HIST_SQL = with_views(f", {REPORT_CTE}\n" + histogram_sql("rep", "deviation_m", 80),
                          "cloud_source", "cloud_target")


def q_alert_table(spark, sf):
    a = CL.alert_table(_report(spark, sf), THRESHOLD, 500)
    return a.select("pt_id", "x", "y", "z", r6("deviation_m"))


ALERT_SQL = with_views(f""", {REPORT_CTE}
SELECT pt_id, x, y, z, round(deviation_m, 6) AS deviation_m FROM rep WHERE deviation_m > {THRESHOLD}
ORDER BY rep.deviation_m DESC, pt_id LIMIT 500""", "cloud_source", "cloud_target")


def q_deviation_sample(spark, sf):
    return sample_rows(_report(spark, sf), 50_000, id_col="pt_id").select("pt_id", "x", "y", "z", r6("deviation_m"))


DEV_SAMPLE_SQL = with_views(f""", {REPORT_CTE}
SELECT pt_id, x, y, z, round(deviation_m, 6) AS deviation_m FROM rep ORDER BY {hash32_sql('pt_id')}, pt_id LIMIT 50000""",
                            "cloud_source", "cloud_target")

ALIGN_MAX = 0.05


def q_align_quality(spark, sf):
    q = CL.align_quality(common.cloud_source(spark, sf), common.cloud_target(spark, sf), ALIGN_MAX)
    return q.select(r6("fitness"), r6("inlier_rmse"), "n_inliers")


ALIGN_SQL = with_views(f""", {NN_CTE}
SELECT round(count(CASE WHEN deviation_m <= {ALIGN_MAX} THEN 1 END) / count(*), 6) AS fitness,
  round(sqrt(avg(CASE WHEN deviation_m <= {ALIGN_MAX} THEN deviation_m * deviation_m END)), 6) AS inlier_rmse,
  count(CASE WHEN deviation_m <= {ALIGN_MAX} THEN 1 END) AS n_inliers FROM nn""", "cloud_source", "cloud_target")


def q_mesh_distance(spark, sf):
    d = CL.mesh_distance(common.cloud_source(spark, sf), common.mesh_triangles(spark, sf))
    return d.select("pt_id", r6("deviation_m"))


def _mesh_sql() -> str:
    tc = CL.triangle_constants_sql()
    stages, final = CL.point_triangle_sql()
    tri_sel = ", ".join(f"{tc[n]} AS {n}" for n in CL.TRI_CONST_STAGES[0])
    tri_sel2 = ", ".join(f"{tc[n]} AS {n}" for n in CL.TRI_CONST_STAGES[1])
    steps = ",\n".join(f"st{i} AS (SELECT *, {', '.join(f'{stages[n]} AS {n}' for n in g)} FROM {'cand' if i == 0 else f'st{i - 1}'})"
                       for i, g in enumerate(CL.PAIR_STAGES))
    last = f"st{len(CL.PAIR_STAGES) - 1}"
    # Exact candidate set: the distance to the nearest mesh vertex bounds the
    # distance to the mesh, and only triangles whose box lies within that
    # bound of the point can be closer.
    return with_views(f""", verts AS (SELECT DISTINCT x, y, z FROM (
   SELECT ax AS x, ay AS y, az AS z FROM mesh_triangles UNION ALL SELECT bx, by_, bz FROM mesh_triangles
   UNION ALL SELECT cx, cy, cz FROM mesh_triangles) v),
ub AS (SELECT p.pt_id, p.x, p.y, p.z, min(sqrt((p.x - v.x) * (p.x - v.x) + (p.y - v.y) * (p.y - v.y) + (p.z - v.z) * (p.z - v.z))) * 1.000001 + 1e-9 AS ub
   FROM cloud_source p, verts v GROUP BY p.pt_id, p.x, p.y, p.z),
tri0 AS (SELECT *, {tri_sel} FROM mesh_triangles), tri AS (SELECT *, {tri_sel2} FROM tri0),
cand AS (SELECT p.pt_id, p.x AS px, p.y AS py, p.z AS pz, t.* FROM ub p JOIN tri t
  ON p.x BETWEEN least(t.ax, t.bx, t.cx) - p.ub AND greatest(t.ax, t.bx, t.cx) + p.ub
 AND p.y BETWEEN least(t.ay, t.by_, t.cy) - p.ub AND greatest(t.ay, t.by_, t.cy) + p.ub),
{steps}
SELECT pt_id, round(min({final}), 6) AS deviation_m FROM {last} GROUP BY pt_id""", "cloud_source", "mesh_triangles")


MESH_SQL = _mesh_sql()


def q_mesh_deviation_report(spark, sf):
    """The deviation report against a mesh instead of a cloud (C14)."""
    d = CL.mesh_distance(common.cloud_source(spark, sf), common.mesh_triangles(spark, sf))
    rep = CL.deviation_report(d, THRESHOLD, MAX_COLOR_DIST)
    return rep.select("pt_id", r6("deviation_m"), "alert", r6("r"), r6("g"), "b")


_RED = f"least(greatest(deviation_m / {MAX_COLOR_DIST}, 0.0E0), 1.0E0)"
MESH_REPORT_SQL = (f"SELECT pt_id, round(deviation_m, 6) AS deviation_m, deviation_m > {THRESHOLD} AS alert, round({_RED}, 6) AS r, "
                   f"round(1.0E0 - {_RED}, 6) AS g, 0.0E0 AS b FROM ("
                   + MESH_SQL.replace("round(min(", "(min(").replace("), 6) AS deviation_m", ")) AS deviation_m") + ") t")


def union_vertices(triangles: DataFrame) -> DataFrame:
    """Stack the three corners of every triangle into one vertex table."""
    parts = []
    for k, (x, y, z) in enumerate([("ax", "ay", "az"), ("bx", "by_", "bz"), ("cx", "cy", "cz")]):
        parts.append(triangles.select("tri_id", F.lit(k).alias("corner"), F.col(x).alias("x"),
                                      F.col(y).alias("y"), F.col(z).alias("z")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_union_vertices(spark, sf):
    return union_vertices(common.mesh_triangles(spark, sf))


UNION_SQL = with_views(" UNION ALL ".join(
    f"SELECT tri_id, {k} AS corner, {x} AS x, {y} AS y, {z} AS z FROM mesh_triangles"
    for k, (x, y, z) in enumerate([("ax", "ay", "az"), ("bx", "by_", "bz"), ("cx", "cy", "cz")])), "mesh_triangles")


def q_estimate_normals(spark, sf):
    n = CL.estimate_normals(common.cloud_target(spark, sf), radius=2 * VOXEL, max_nn=30)
    return n.select("pt_id", r6("nx"), r6("ny"), r6("nz"))


SAMPLE_N, SAMPLE_RADIUS = 5000, 0.005


def q_mesh_sample(spark, sf):
    """5,000 points, no two within 5 mm."""
    s = CL.mesh_sample(common.mesh_triangles(spark, sf), n=SAMPLE_N, thin_radius=SAMPLE_RADIUS)
    return s.select("pt_id", "tri_id", r6("x"), r6("y"), r6("z"))


def q_mesh_sample_even(spark, sf):
    """1,000 points as far apart as the operator's own radius."""
    s = CL.mesh_sample(common.mesh_triangles(spark, sf), n=1000)
    return s.select("pt_id", "tri_id", r6("x"), r6("y"), r6("z"))


def _mesh_sample_sql(n: int, radius: float | None, draws: int, rounds: int, seed: int = 42) -> str:
    """The sample by rounds over the conflicts: a point is out once a
    neighbour before it is in, and in once all neighbours before it are out.
    An error if ``rounds`` leave a conflict open or ``draws`` draws (n, 2 n,
    4 n, ... candidates) don't bring n points."""
    from sitelens.functions.hashing import unit_hash_sql
    cx_ = "(by_ - ay) * (cz - az) - (bz - az) * (cy - ay)"
    cy_ = "(bz - az) * (cx - ax) - (bx - ax) * (cz - az)"
    cz_ = "(bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax)"
    key = "concat(CAST(tri_id AS VARCHAR), ':', CAST(i AS VARCHAR))"
    coord = {a: f"(1.0E0 - sqrt(r1)) * a{a} + sqrt(r1) * (1.0E0 - r2) * {'by_' if a == 'y' else 'b' + a} + sqrt(r1) * r2 * c{a}"
             for a in "xyz"}
    counts = ", ".join(f"CAST(floor({float(n << d)!r} * area / total + {unit_hash_sql('tri_id', f'{seed}:n')}) AS INTEGER) AS k{d}" for d in range(draws))
    draw = "CASE " + " ".join(f"WHEN i < k{d} THEN {d}" for d in range(draws)) + " END"
    d2 = " + ".join(f"(p.{a} - q.{a}) * (p.{a} - q.{a})" for a in "xyz")
    steps, last = [], "r0"
    for k in range(rounds):
        steps.append(f"""i{k} AS MATERIALIZED (SELECT p FROM {last} WHERE fate IS NULL AND p NOT IN (SELECT a FROM e JOIN {last} ON b = p WHERE coalesce(fate, 1) = 1)),
r{k + 1} AS MATERIALIZED (SELECT p, CASE WHEN fate IS NOT NULL THEN fate WHEN p IN (FROM i{k}) THEN 1
   WHEN p IN (SELECT a FROM e JOIN i{k} ON b = p) THEN 0 END AS fate FROM {last})""")
        last = f"r{k + 1}"
    return with_views(f""", tri AS (SELECT *, sqrt(({cx_}) * ({cx_}) + ({cy_}) * ({cy_}) + ({cz_}) * ({cz_})) / 2 AS area
   FROM mesh_triangles),
tot AS (SELECT sum(area) AS total, {f'{radius!r}' if radius else f'sqrt(sum(area) / {n} / 2)'} AS radius FROM tri),
cnt AS (SELECT tri.*, {counts} FROM tri, tot),
rep AS (SELECT cnt.*, i, {draw} AS draw FROM cnt, range(0, k{draws - 1}) r(i) WHERE k{draws - 1} > 0),
uv AS (SELECT *, {unit_hash_sql(key, f'{seed}:u')} AS r1, {unit_hash_sql(key, f'{seed}:v')} AS r2, {hash32_sql(key, seed)} AS h FROM rep),
pts AS MATERIALIZED (SELECT row_number() OVER (ORDER BY draw, h, tri_id, i) AS p, tri_id * {1 << 20} + i AS pt_id, tri_id,
   {coord['x']} AS x, {coord['y']} AS y, {coord['z']} AS z, radius FROM uv, tot),
near AS (SELECT *, CAST(floor(x / radius) AS BIGINT) AS gx, CAST(floor(y / radius) AS BIGINT) AS gy FROM pts),
e AS MATERIALIZED (SELECT p.p AS a, q.p AS b FROM (SELECT *, gx + dx AS hx, gy + dy AS hy FROM near, range(-1, 2) u(dx), range(-1, 2) v(dy)) p
   JOIN near q ON q.gx = p.hx AND q.gy = p.hy WHERE q.p < p.p AND {d2} <= p.radius * p.radius),
r0 AS MATERIALIZED (SELECT DISTINCT p, NULL::INTEGER AS fate FROM (SELECT a AS p FROM e UNION ALL SELECT b FROM e) z),
{', '.join(steps)},
done AS (SELECT pts.*, CASE WHEN {last}.p IS NULL THEN 1 WHEN fate IS NULL THEN CAST(error('conflicts left open') AS INTEGER) ELSE fate END AS fate
   FROM pts LEFT JOIN {last} ON {last}.p = pts.p),
best AS (SELECT * FROM done WHERE fate = 1 ORDER BY p LIMIT {n})
SELECT pt_id, tri_id, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM best
WHERE CASE WHEN (SELECT count(*) FROM best) < {n} THEN CAST(error('too few points') AS BOOLEAN) ELSE true END""", "mesh_triangles")


MESH_SAMPLE_SQL = _mesh_sample_sql(SAMPLE_N, SAMPLE_RADIUS, draws=4, rounds=24)
MESH_SAMPLE_EVEN_SQL = _mesh_sample_sql(1000, None, draws=4, rounds=24)


def q_knn_radius(spark, sf):
    from sitelens.operators.spatial import knn_radius
    k = knn_radius(common.cloud_target(spark, sf), CL.XYZ, 2 * VOXEL, 30, id_col="pt_id")
    return k.select("a", "b", r6("dist"), F.col("nn_rank").cast("int").alias("nn_rank"))


KNN_SQL = with_views(f"""SELECT a, b, round(dist, 6) AS dist, CAST(nn_rank AS INTEGER) AS nn_rank FROM (
  SELECT a.pt_id AS a, b.pt_id AS b, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) AS dist,
    row_number() OVER (PARTITION BY a.pt_id ORDER BY sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)), b.pt_id) AS nn_rank
  FROM cloud_target a JOIN cloud_target b ON abs(a.x - b.x) <= {2 * VOXEL} AND abs(a.y - b.y) <= {2 * VOXEL}
  WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) <= {(2 * VOXEL) ** 2!r}) t
WHERE nn_rank <= 30""", "cloud_target")


def q_eps_pairs(spark, sf):
    from sitelens.operators.spatial import eps_pairs
    p = eps_pairs(common.cluster_points(spark, sf), ["f0", "f1", "f2"], 0.18, id_col="pt_id")
    return p.select("a", "b", r6("dist"))


EPS_SQL = with_views("""SELECT a.pt_id AS a, b.pt_id AS b,
  round(sqrt((a.f0 - b.f0) * (a.f0 - b.f0) + (a.f1 - b.f1) * (a.f1 - b.f1) + (a.f2 - b.f2) * (a.f2 - b.f2)), 6) AS dist
FROM cluster_points a JOIN cluster_points b ON abs(a.f0 - b.f0) <= 0.18 AND abs(a.f1 - b.f1) <= 0.18
WHERE (a.f0 - b.f0) * (a.f0 - b.f0) + (a.f1 - b.f1) * (a.f1 - b.f1) + (a.f2 - b.f2) * (a.f2 - b.f2) <= 0.0324""",
                     "cluster_points")


def q_nn_join(spark, sf):
    """Held-out points to their nearest training point (hash split)."""
    from sitelens.operators.cluster import split_train_test
    from sitelens.operators.spatial import nn_join
    pts = split_train_test(common.cluster_points(spark, sf), "pt_id")
    nn = nn_join(pts.filter(F.col("split") == "test"), pts.filter(F.col("split") == "train"), ["f0", "f1", "f2"])
    return nn.select("pt_id", "nn_id", r6("nn_dist"))


def _nn_join_sql() -> str:
    from sitelens.functions.hashing import unit_hash_sql
    train = f"{unit_hash_sql('pt_id', 42)} < 0.7"
    return with_views(f"""SELECT pt_id, nn_id, round(sqrt(sq), 6) AS nn_dist FROM (
  SELECT a.pt_id, b.pt_id AS nn_id, (a.f0 - b.f0) * (a.f0 - b.f0) + (a.f1 - b.f1) * (a.f1 - b.f1) + (a.f2 - b.f2) * (a.f2 - b.f2) AS sq,
    row_number() OVER (PARTITION BY a.pt_id ORDER BY (a.f0 - b.f0) * (a.f0 - b.f0) + (a.f1 - b.f1) * (a.f1 - b.f1) + (a.f2 - b.f2) * (a.f2 - b.f2), b.pt_id) AS rn
  FROM (SELECT * FROM cluster_points WHERE NOT ({train.replace('pt_id', 'cluster_points.pt_id')})) a,
       (SELECT * FROM cluster_points WHERE {train.replace('pt_id', 'cluster_points.pt_id')}) b) t WHERE rn = 1""", "cluster_points")


NN_JOIN_SQL = _nn_join_sql()


for _name, _fn, _sql in [
    ("cloud_sample", q_cloud_sample, CLOUD_SAMPLE_SQL),
    ("voxel_downsample", q_voxel_downsample, VOXEL_SQL),
    ("apply_transform", q_apply_transform, TRANSFORM_SQL),
    ("cloud_distance", q_cloud_distance, CLOUD_DIST_SQL),
    ("deviation_report", q_deviation_report, REPORT_SQL),
    ("deviation_color", q_deviation_color, COLOR_SQL),
    ("deviation_stats", q_deviation_stats, STATS_SQL),
    ("deviation_histogram", q_deviation_histogram, DEV_HIST_SQL),
    ("alert_table", q_alert_table, ALERT_SQL),
    ("deviation_sample", q_deviation_sample, DEV_SAMPLE_SQL),
    ("align_quality", q_align_quality, ALIGN_SQL),
    ("mesh_distance", q_mesh_distance, MESH_SQL),
    ("mesh_deviation_report", q_mesh_deviation_report, MESH_REPORT_SQL),
    ("union_vertices", q_union_vertices, UNION_SQL),
    ("estimate_normals", q_estimate_normals, None),
    ("mesh_sample", q_mesh_sample, MESH_SAMPLE_SQL),
    ("mesh_sample_even", q_mesh_sample_even, MESH_SAMPLE_EVEN_SQL),
    ("knn_radius", q_knn_radius, KNN_SQL),
    ("eps_pairs", q_eps_pairs, EPS_SQL),
    ("nn_join", q_nn_join, NN_JOIN_SQL),
]:
    add(_name, _fn, _sql)
