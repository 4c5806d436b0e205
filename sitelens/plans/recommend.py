"""Recommendation plans: every click ranked at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.geo import haversine_sql
from sitelens.operators.ranking import display_round, recommend
from sitelens.plans import common
from sitelens.sources.fixtures import with_views


def recommend_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: clean venues -> radius join with every click -> persona
    score -> top 10 per click, display-rounded."""
    out = recommend(common.clicks(spark, sf_dir), common.venues(spark, sf_dir), k=10)
    return display_round(out)


def persona_case_sql(persona: str, feature: str) -> str:
    from sitelens.operators.ranking import DEFAULT_PERSONA, PERSONA_WEIGHTS
    whens = " ".join(f"WHEN '{p}' THEN {w[feature]!r}E0" for p, w in PERSONA_WEIGHTS.items())
    return f"(CASE {persona} {whens} ELSE {PERSONA_WEIGHTS[DEFAULT_PERSONA][feature]!r}E0 END)"


def score_sql(persona: str, rating: str, price: str, dist: str) -> str:
    return (f"({persona_case_sql(persona, 'rating')} * {rating} + "
            f"{persona_case_sql(persona, 'price_nis')} * {price} / 10 + "
            f"{persona_case_sql(persona, 'distance_km')} * {dist})")


def pairs_sql(queries: str = "clicks", venues: str = "venues", extra: str = "") -> str:
    """All (query, eligible venue) pairs within the query radius, as SQL."""
    dist = haversine_sql("q.lat", "q.lng", "v.lat", "v.lng")
    return f"""
    SELECT q.query_id, q.persona, q.max_dist_km, v.row_id, v.name, v.city, v.rating, v.price_nis,
           v.google_maps_url, v.lat, v.lng{extra}, {dist} AS distance_km
    FROM {queries} q JOIN {venues} v
      ON v.lat BETWEEN q.lat - q.max_dist_km / 100.0E0 AND q.lat + q.max_dist_km / 100.0E0
    WHERE v.price_nis IS NOT NULL AND v.rating IS NOT NULL AND {dist} <= q.max_dist_km"""


RECOMMEND_TOPK_SQL = with_views(f"""
, pairs AS ({pairs_sql()}),
scored AS (SELECT *, {score_sql('persona', 'rating', 'price_nis', 'distance_km')} AS score FROM pairs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id) AS rank FROM scored)
SELECT query_id, persona, rank, row_id, name, city, rating, price_nis, round(distance_km, 2) AS distance_km,
       round(score, 2) AS score, google_maps_url
FROM ranked WHERE rank <= 10
""", "venues", "clicks")


def radius_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 alone: every (click, venue) pair within the click's radius."""
    from sitelens.operators.spatial import radius_join
    v = common.venues(spark, sf_dir).select("row_id", "lat", "lng")
    q = common.clicks(spark, sf_dir).select("query_id", "lat", "lng", "max_dist_km")
    return radius_join(q, v).select("query_id", "row_id", F.round("distance_km", 6).alias("distance_km"))


RADIUS_JOIN_SQL = with_views(f"""SELECT q.query_id, v.row_id, round({haversine_sql('q.lat', 'q.lng', 'v.lat', 'v.lng')}, 6) AS distance_km
FROM clicks q JOIN venues v ON v.lat BETWEEN q.lat - q.max_dist_km / 100.0E0 AND q.lat + q.max_dist_km / 100.0E0
WHERE {haversine_sql('q.lat', 'q.lng', 'v.lat', 'v.lng')} <= q.max_dist_km""", "venues", "clicks")
