"""Great-circle distance as a native expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meltemi import settings as S


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # Rounding can push the chord of two antipodes past 1, where asin is undefined.
    return F.lit(2 * S.EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))
