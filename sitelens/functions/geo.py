"""Geographic column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle distance in km.

    Term order is fixed (sin^2 of half the latitude gap, plus the cosine
    product times sin^2 of half the longitude gap) so equal inputs give equal
    doubles in every engine; the argument of asin is clamped to 1.
    """
    lat1, lng1, lat2, lng2 = map(_c, (lat1, lng1, lat2, lng2))
    s_lat = F.sin(F.radians(lat2 - lat1) / 2)
    s_lng = F.sin(F.radians(lng2 - lng1) / 2)
    a = s_lat * s_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * (s_lng * s_lng)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def haversine_sql(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    """The same formula as SQL text (for oracles and SQL users)."""
    s_lat = f"sin(radians({lat2} - {lat1}) / 2)"
    s_lng = f"sin(radians({lng2} - {lng1}) / 2)"
    a = f"{s_lat} * {s_lat} + cos(radians({lat1})) * cos(radians({lat2})) * ({s_lng} * {s_lng})"
    return f"({2 * EARTH_RADIUS_KM!r} * asin(sqrt(least(1.0E0, {a}))))"


def lat_radius_deg(radius_km) -> Column:
    """Half-height in degrees of the box around a circle of this radius."""
    return F.degrees(_c(radius_km) / EARTH_RADIUS_KM)


def lng_radius_deg(lat, radius_km) -> Column:
    """Half-width in degrees of the box around a circle of this radius.

    Null when the circle reaches a pole (then every longitude qualifies).
    """
    lat, radius_km = _c(lat), _c(radius_km)
    ang = radius_km / EARTH_RADIUS_KM
    ratio = F.sin(ang) / F.cos(F.radians(lat))
    reaches_pole = (F.abs(lat) + F.degrees(ang)) >= 90.0
    return F.when(reaches_pole | (ratio >= 1.0), F.lit(None).cast("double")).otherwise(
        F.degrees(F.asin(ratio)))


def sub_area(lat) -> Column:
    """Sub-area of the Haifa box by latitude."""
    lat = _c(lat)
    # Latitude cut points and names of the three sub-areas.
    return (F.when(lat >= 32.84, F.lit("Krayot"))
            .when(lat >= 32.78, F.lit("Haifa"))
            .otherwise(F.lit("Carmel")))


# The Haifa / Krayot / Carmel bounding box.
HAIFA_BBOX = {"lat_min": 32.70, "lat_max": 32.95, "lng_min": 34.93, "lng_max": 35.15}
