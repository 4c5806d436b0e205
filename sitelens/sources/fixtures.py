"""Deterministic fixture views over the driver tables (see FIXTURES.md).

Each view is one SQL text that runs unchanged in Spark and DuckDB. Table
references are ``{name}`` placeholders: Spark binds them to DataFrames read
from the parquet folder (``spark.sql(text, name=df)``), the DuckDB oracle
fills in plain view names and inlines the texts as CTEs.

The ``venues`` text is kept only for the oracle; the engine derives the clean
table with its own DataFrame code (``operators.clean.clean_venues``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

VENUES_RAW = """
SELECT o.o_orderkey AS row_id,
  CASE WHEN k % 97 = 0 THEN NULL ELSE 29.6 + 0.14*((k*7)%25) + (((k*7919)%1000)-500)/10000.0E0 END AS latitude,
  34.4E0 + 0.026E0*((k*7)%25) + (((k*104729)%1000)-500)/10000.0E0 AS longitude,
  n.n_name AS city,
  concat('Venue#', CAST(k AS VARCHAR(20))) AS name,
  CASE WHEN k % 26 = 0 THEN NULL WHEN k % 211 = 0 THEN 'N/A'
       ELSE concat(CAST(CAST(floor((10+(k*31)%41)/10.0E0) AS INT) AS VARCHAR(9)), '.', CAST((10+(k*31)%41)%10 AS VARCHAR(9))) END AS rating,
  CASE WHEN k % 26 = 0 THEN NULL ELSE CAST((k*101)%2000 AS VARCHAR(9)) END AS reviews_count,
  CASE WHEN k % 89 = 0 THEN NULL ELSE CAST(37+(k*13)%12+(k*29)%11 AS VARCHAR(9)) END AS price_turkey_shawarma_pita,
  CAST(41+(k*13)%12+(k*17)%11 AS VARCHAR(9)) AS price_cow_shawarma_pita,
  CAST(43+(k*13)%12+(k*19)%11 AS VARCHAR(9)) AS price_turkey_shawarma_laffa,
  CAST(47+(k*13)%12+(k*23)%11 AS VARCHAR(9)) AS price_cow_shawarma_laffa,
  CAST(20+(k*13)%12 AS VARCHAR(9)) AS price_falafel_pita,
  CASE WHEN k % 53 = 0 THEN 'n/a' ELSE CAST(25+(k*13)%12 AS VARCHAR(9)) END AS price_falafel_laffa,
  CASE WHEN k % 31 = 0 THEN NULL WHEN k % 3 = 0 THEN 'True' ELSE 'False' END AS car_park_nearby,
  CASE WHEN k % 1000 = 7 THEN 'verified' ELSE 'estimated' END AS price_source,
  concat('https://maps.example/?q=', CAST(k AS VARCHAR(20))) AS google_maps_url
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS k FROM {orders}) o
JOIN {nation} n ON n.n_nationkey = o.k % 25
"""

VENUES = """
SELECT row_id, lat, lng, city, name, rating, reviews_count,
  price_turkey_shawarma_pita, price_cow_shawarma_pita, price_turkey_shawarma_laffa, price_cow_shawarma_laffa, price_falafel_pita, price_falafel_laffa,
  price_turkey_shawarma_pita AS price_nis,
  CAST(coalesce(reviews_count, 0) AS INT) AS ratings_count, car_park_nearby, price_source, google_maps_url
FROM (SELECT row_id, latitude AS lat, longitude AS lng, city, name,
  try_cast(rating AS DOUBLE) AS rating, try_cast(reviews_count AS DOUBLE) AS reviews_count,
  try_cast(price_turkey_shawarma_pita AS DOUBLE) AS price_turkey_shawarma_pita,
  try_cast(price_cow_shawarma_pita AS DOUBLE) AS price_cow_shawarma_pita,
  try_cast(price_turkey_shawarma_laffa AS DOUBLE) AS price_turkey_shawarma_laffa,
  try_cast(price_cow_shawarma_laffa AS DOUBLE) AS price_cow_shawarma_laffa,
  try_cast(price_falafel_pita AS DOUBLE) AS price_falafel_pita,
  try_cast(price_falafel_laffa AS DOUBLE) AS price_falafel_laffa,
  CASE car_park_nearby WHEN 'True' THEN true WHEN 'False' THEN false END AS car_park_nearby,
  price_source, google_maps_url,
  row_number() OVER (PARTITION BY name, latitude, longitude ORDER BY row_id) AS rn
  FROM {venues_raw} WHERE latitude IS NOT NULL AND longitude IS NOT NULL) t
WHERE rn = 1
"""

CLICKS = """
SELECT event_id AS query_id, ts, user_id,
  32.70E0 + 0.25E0*((event_id*7919)%1000)/1000.0E0 AS lat, 34.93E0 + 0.22E0*((event_id*104729)%1000)/1000.0E0 AS lng,
  CASE WHEN event_id % 2 = 0 THEN 'student' ELSE 'quality' END AS persona,
  0.5E0 + 0.5E0*(event_id % 10) AS max_dist_km
FROM {events} WHERE event_type = 'click'
"""

CLUSTER_POINTS = """
SELECT p_partkey AS pt_id,
 CASE WHEN p_partkey % 40 = 0 THEN ((p_partkey*7919)%2001-1000)/100.0E0 ELSE 2.0E0*(p_partkey%6) - 5 + (((p_partkey*7919)%1000)-500)/1000.0E0 END AS f0,
 CASE WHEN p_partkey % 40 = 0 THEN ((p_partkey*104729)%2001-1000)/100.0E0 ELSE 3.0E0*(p_partkey%2) + (((p_partkey*6007)%1000)-500)/1000.0E0 END AS f1,
 CASE WHEN p_partkey % 40 = 0 THEN ((p_partkey*1299709)%2001-1000)/100.0E0 ELSE 2.0E0*(p_partkey%3) + (((p_partkey*3571)%1000)-500)/1000.0E0 END AS f2
FROM {part}
"""

CLOUD_TARGET = """
SELECT p_partkey AS pt_id, (p_partkey%50)*0.04E0 AS x, floor(p_partkey/50.0E0)*0.04E0 AS y, ((p_partkey*7)%10)*0.002E0 AS z FROM {part}
"""

CLOUD_SOURCE = """
SELECT o_orderkey AS pt_id, ((o_orderkey*17)%2000)/1000.0E0 AS x, ((o_orderkey*23)%1600)/1000.0E0 AS y, ((o_orderkey*29)%400)/2000.0E0 AS z FROM {orders}
"""

MESH_TRIANGLES = """
SELECT a.pt_id*2+h.h AS tri_id, a.x AS ax, a.y AS ay, a.z AS az,
  CASE WHEN h.h=0 THEN b.x ELSE d.x END AS bx, CASE WHEN h.h=0 THEN b.y ELSE d.y END AS by_, CASE WHEN h.h=0 THEN b.z ELSE d.z END AS bz,
  CASE WHEN h.h=0 THEN d.x ELSE c.x END AS cx, CASE WHEN h.h=0 THEN d.y ELSE c.y END AS cy, CASE WHEN h.h=0 THEN d.z ELSE c.z END AS cz
FROM {cloud_target} a JOIN {cloud_target} b ON b.pt_id=a.pt_id+1 JOIN {cloud_target} c ON c.pt_id=a.pt_id+50 JOIN {cloud_target} d ON d.pt_id=a.pt_id+51
CROSS JOIN (SELECT 0 AS h UNION ALL SELECT 1 AS h) h WHERE a.pt_id % 50 < 49
"""

PLACES_PAGES = """
SELECT s_suppkey AS page_id, concat('{{"places":[{{"displayName":{{"text":"', s_name, '"}},"formattedAddress":"Street ', CAST(s_nationkey AS VARCHAR(9)),
 '","location":{{"latitude":32.', CAST(100+s_suppkey%800 AS VARCHAR(9)), ',"longitude":34.', CAST(100+(s_suppkey*7)%800 AS VARCHAR(9)), '}},"rating":4.', CAST(s_suppkey%10 AS VARCHAR(9)),
 ',"userRatingCount":', CAST(s_suppkey*3 AS VARCHAR(9)), '}},{{"formattedAddress":"only address"}}]',
 CASE WHEN s_suppkey % 5 = 4 THEN '' ELSE concat(',"nextPageToken":"t', CAST(s_suppkey+1 AS VARCHAR(9)), '"') END, '}}') AS body FROM {supplier}
"""

# name -> (sql text, the names it references)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "venues_raw": (VENUES_RAW, ("orders", "nation")),
    "venues": (VENUES, ("venues_raw",)),
    "clicks": (CLICKS, ("events",)),
    "cluster_points": (CLUSTER_POINTS, ("part",)),
    "cloud_target": (CLOUD_TARGET, ("part",)),
    "cloud_source": (CLOUD_SOURCE, ("orders",)),
    "mesh_triangles": (MESH_TRIANGLES, ("cloud_target",)),
    "places_pages": (PLACES_PAGES, ("supplier",)),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view as a Spark DataFrame over the driver parquet tables."""
    text, deps = VIEWS[name]
    bound = {}
    for dep in deps:
        # views joined with each other grow alike: none is broadcast on a guess of its size
        bound[dep] = view(spark, sf_dir, dep).hint("merge") if dep in VIEWS else read_table(spark, sf_dir, dep)
    return spark.sql(text, **bound)


def _duck_text(name: str) -> str:
    text, deps = VIEWS[name]
    return text.format(**{d: d for d in deps})


def with_views(select_sql: str, *names: str) -> str:
    """Inline fixture views (and what they need) as CTEs in front of a query."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or n not in VIEWS:
            return
        for dep in VIEWS[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return select_sql
    ctes = ",\n".join(f"{n} AS ({_duck_text(n).strip()})" for n in order)
    return f"WITH {ctes}\n{select_sql.strip()}"
