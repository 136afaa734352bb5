"""Number or code to label, as when chains and literal maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from meltemi import settings as S


def upper_inclusive(c: Column, edges: Sequence[tuple[float, str]], top: str) -> Column:
    """Label of the first edge the value does not exceed; null has no label."""
    chain = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in edges:
        chain = chain.when(c <= edge, label)
    return chain.otherwise(top)


def left_closed(c: Column, edges: Sequence[tuple[float, str]], top: str) -> Column:
    """Label of the first edge the value lies below; null is 'unknown'."""
    chain = F.when(c.isNull(), "unknown")
    for edge, label in edges:
        chain = chain.when(c < edge, label)
    return chain.otherwise(top)


def aqi_category(pm25: Column) -> Column:
    return F.coalesce(upper_inclusive(pm25, S.AQI_TIERS, S.AQI_TOP), F.lit("unknown"))


def risk_level(risk_index: Column) -> Column:
    return upper_inclusive(risk_index, S.RISK_EDGES, S.RISK_TOP)


def wind_level(gust: Column) -> Column:
    return left_closed(gust, S.WIND_BANDS, S.WIND_TOP)


def dust_level(dust: Column) -> Column:
    return left_closed(dust, S.DUST_BANDS, S.DUST_TOP)


def wmo_condition(code: Column) -> Column:
    """Present-weather code to a word. A code is truncated to its whole part first."""
    whole = code.try_cast("int")
    chain = F.when(whole.isNull(), "unknown")
    for label, codes in S.WMO_CONDITIONS.items():
        chain = chain.when(whole.isin(*codes), label)
    return chain.otherwise("unknown")


def severity_rank(label: Column, order: Sequence[str]) -> Column:
    """Position in a least-to-most-severe list; null for a label outside it."""
    chain = F.when(label == order[0], 0)
    for rank, name in enumerate(order[1:], start=1):
        chain = chain.when(label == name, rank)
    return chain


def worst(label: Column, order: Sequence[str]) -> Column:
    """Aggregate: the most severe known label of a group, 'unknown' when there is none.

    A max over an integer rank combines map-side, where a Python aggregate would not.
    """
    names = F.array(*[F.lit(name) for name in order])
    # 'unknown' comes first in every order. The index must not be null: Spark takes an element
    # of a null-free array for non-null whatever its index is.
    top = F.coalesce(F.max(severity_rank(label, order)), F.lit(0))
    return F.element_at(names, top + 1)
