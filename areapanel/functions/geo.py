"""Great-circle distance as native column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import EARTH_RADIUS_KM


def haversine_term(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Squared half chord; grows with distance, so comparisons need no arcsine."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    return F.pow(F.sin(half_lat), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lon), F.lit(2)
    )


def term_to_km(term: Column) -> Column:
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(term, F.lit(1.0))))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return term_to_km(haversine_term(lat1, lon1, lat2, lon2))


def km_to_term(km: float) -> float:
    angle = min(km / (2 * EARTH_RADIUS_KM), math.pi / 2)
    return math.sin(angle) ** 2
