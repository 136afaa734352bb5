"""Keep stations near the cities they were searched under."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meltemi import settings as S
from meltemi.functions.numeric import to_double


def near_known_city(
    lat: Column, lon: Column, country: Column,
    anchors: dict[str, tuple[tuple[float, float], ...]] = S.CITY_ANCHORS,
    max_km: float = S.ANCHOR_MAX_KM,
) -> Column:
    """True within max_km of any anchor of the row's country, or where it has no anchors.

    The anchor list is a short constant, so the semi-join on distance is an expression of the
    row alone: no shuffle, and a country with most of the rows is no different from another.
    A distance is at most max_km exactly when the cosine of its angle is at least that of
    max_km. The n-th anchors of all countries share one test, with the country picking the
    constants, so the expression grows with the anchors per country and not with their sum.
    """
    code = F.upper(F.coalesce(country, F.lit("")))
    phi, lam = F.radians(lat), F.radians(lon)
    least_cosine = math.cos(min(max_km / S.EARTH_RADIUS_KM, math.pi))
    near = F.lit(False)
    for n in range(max(map(len, anchors.values()), default=0)):
        nth = {name: tuple(map(math.radians, points[n])) for name, points in anchors.items() if len(points) > n}

        def constant(pick) -> Column:
            chain = F.lit(None).cast("double")
            for name, point in nth.items():
                chain = F.when(code == name, pick(point)).otherwise(chain)
            return chain

        cosine = F.sin(phi) * constant(lambda p: math.sin(p[0])) + F.cos(phi) * constant(
            lambda p: math.cos(p[0])
        ) * F.cos(lam - constant(lambda p: p[1]))
        # NaN compares above every number, so an upper bound keeps it out.
        near = near | F.coalesce(cosine.between(least_cosine, 2.0), F.lit(False))
    return F.when(code.isin(*anchors), near).otherwise(True) if anchors else F.lit(True)


def _near(df: DataFrame, max_km: float = S.ANCHOR_MAX_KM) -> Column:
    """The same over a frame's own columns; coordinates that are no numbers count as missing."""
    place = [
        F.col(c) if df.schema[c].dataType.typeName() == "double" else to_double(c)
        for c in ("latitude", "longitude")
    ]
    return near_known_city(*place, F.col("country_code"), max_km=max_km)


def keep_near_cities(df: DataFrame, max_km: float = S.ANCHOR_MAX_KM) -> DataFrame:
    return df.filter(_near(df, max_km))


def report_countries(df: DataFrame, excluded: tuple[str, ...] = S.EXCLUDED_COUNTRIES) -> DataFrame:
    """Drop excluded countries, and station-feed rows that are nowhere near their city.

    A null country is kept. The distance rule needs coordinates and a source; a frame
    without them only gets the country rule.
    """
    if "country_code" not in df.columns:
        return df
    out = df.filter(F.coalesce(~F.col("country_code").isin(*excluded), F.lit(True)))
    if {"latitude", "longitude", "source"} <= set(df.columns):
        out = out.filter(~F.col("source").eqNullSafe("waqi") | _near(df))
    return out
