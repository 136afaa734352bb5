"""ISO date text, payload stamps and seasons."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: meteorological seasons, in the order of (month % 12) // 3
SEASONS = ("winter", "spring", "summer", "autumn")


def iso_date(c: Column) -> Column:
    """Any ISO date or timestamp to 'YYYY-MM-DD'; unparsable input becomes null."""
    return F.date_format(c.try_cast("timestamp"), "yyyy-MM-dd")


def stamp_date(stamp: Column) -> Column:
    """Date part of a payload stamp: its first ten characters."""
    return F.substring(stamp, 1, 10)


def season_of(day: Column) -> Column:
    names = F.array(*[F.lit(name) for name in SEASONS])
    place = F.floor(F.month(day) % 12 / 3).cast("int") + 1
    return F.when(day.isNotNull(), F.element_at(names, F.coalesce(place, F.lit(1))))


def parse_dates(raw: str) -> list[str]:
    """Comma- or space-separated ISO dates, first occurrence kept; a bad one raises."""
    found = [date.fromisoformat(token).isoformat() for token in raw.replace(",", " ").split()]
    return list(dict.fromkeys(found))


def date_list(raw: Column) -> Column:
    """The same over a column: an array of ISO dates; a null text gives none, a bad date fails the query."""
    tokens = F.filter(F.split(F.coalesce(raw, F.lit("")), r"[,\s]+"), lambda t: t != "")
    return F.array_distinct(F.transform(tokens, lambda t: t.cast("date").cast("string")))
