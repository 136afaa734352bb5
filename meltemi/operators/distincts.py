"""Exact distinct counts that add up: stored bitmaps of numbered stations.

A count of distinct stations cannot be combined with another, the set behind it can. Stations get a
number once, and each day stores, per group, bitmaps of 32,768 numbers each. A roll-up over days,
countries or sources joins bitmaps bit by bit and counts what is set, so it reads a few bytes per
station-day and never the readings again; a refreshed day replaces its own bitmaps only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meltemi.operators import sinks
from meltemi.operators.gold import with_country
from meltemi.sources import tables

NUMBERS = "station_id string, number long, round string"
BITMAPS = "country_code string, source string, bucket long, bitmap binary, partition_date string"
#: Numbers of a round of new stations lie together, each task's in a row, so they share bitmaps.
ROUND_SPAN = 50


def number_stations(spark: SparkSession, rows: DataFrame, path: str) -> int:
    """Give a number to each station of rows that has none yet; returns how many.

    Numbers are distinct and stay: a round starts where no earlier one reaches, and a task numbers its
    stations in a row, without gathering them.
    """
    held = tables.read_or_empty(spark, path, NUMBERS)
    new = rows.select("station_id").filter("station_id is not null").distinct().join(held.select("station_id"), "station_id", "left_anti")
    rounds = len(sinks.list_partitions(spark, path, ("round",)))
    own = F.monotonically_increasing_id()
    # monotonically_increasing_id leaves 2^33 numbers to a task; bitmaps only care that they run on inside one.
    numbered = new.withColumns({"number": own + F.lit(rounds << ROUND_SPAN), "round": F.lit(f"{rounds:06d}")})
    return sinks.append(numbered.select("station_id", "number", "round"), path, ("round",)).rows


def daily_bitmaps(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """One row per day, country, source and 32,768 station numbers."""
    known = with_country(rows).join(numbers.select("station_id", "number"), "station_id")
    return known.groupBy("partition_date", "country_code", "source", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))


def refresh(spark: SparkSession, rows: DataFrame, root: str, start: str | None = None, end: str | None = None) -> sinks.Written:
    """Number the stations of rows and replace the bitmaps of the days in [start, end]; other days keep theirs."""
    numbers = f"{root}/station_numbers"
    number_stations(spark, rows, numbers)
    built = daily_bitmaps(rows, tables.read_table(spark, numbers, ddl=NUMBERS))
    return sinks.replace_range(built, f"{root}/station_bitmaps", start, end)


def stored(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_table(spark, f"{root}/station_bitmaps", ddl=BITMAPS)


def week() -> Column:
    """Monday of the week."""
    return F.date_trunc("week", F.col("partition_date").cast("date")).cast("date").cast("string")


def month() -> Column:
    return F.substring("partition_date", 1, 7)


def roll_up(bitmaps: DataFrame, **groups: Column) -> DataFrame:
    """(groups..., stations): distinct stations of each group, from bitmaps alone."""
    joined = bitmaps.groupBy(*[c.alias(n) for n, c in groups.items()], "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return joined.groupBy(*groups).agg(F.sum(F.bitmap_count("bitmap")).alias("stations"))


def roll_up_sets(bitmaps: DataFrame, sets: list[list[str]], **groups: Column) -> DataFrame:
    """The same for several sets of groups in one pass; a column that a set leaves out is null, `level` numbers the sets."""
    named = bitmaps.select(*[c.alias(n) for n, c in groups.items()], "bucket", "bitmap")
    expanded = named.select("bucket", "bitmap", F.inline(F.array(*[
        F.struct(F.lit(k).alias("level"), *[(F.col(n) if n in own else F.lit(None).cast("string")).alias(n) for n in groups])
        for k, own in enumerate(sets)])))
    return roll_up(expanded, level=F.col("level"), **{n: F.col(n) for n in groups})
