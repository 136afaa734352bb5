"""Landed rows to Bronze tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meltemi import settings as S
from meltemi.functions.numeric import round_raw, to_double
from meltemi.session import scratch_path

PIVOT_KEYS = ("station_id", "station_name", "city", "country_code", "latitude", "longitude", "date")


def hourly_to_daily(hours: DataFrame, keys: tuple[str, ...] = ("station_id", "date")) -> DataFrame:
    """Daily mean per pollutant; a pollutant with no value that day is null."""
    return hours.groupBy(*keys).agg(
        *[round_raw(F.avg(name), 4).alias(name) for name in S.POLLUTANTS]
    )


def dust_to_daily(hours: DataFrame) -> DataFrame:
    return hours.groupBy("station_id", "date").agg(round_raw(F.avg("dust"), 2).alias("dust"))


def attach_dust(weather: DataFrame, dust: DataFrame) -> DataFrame:
    """Dust rides on its own payload: a day without it keeps its weather and a null dust."""
    return weather.drop("dust").join(dust, ["station_id", "date"], "left")


def pivot_measurements(
    long: DataFrame,
    keys: tuple[str, ...] = PIVOT_KEYS,
    drop_null_keys: bool = False,
) -> DataFrame:
    """Mean per station, date and parameter, spread into one column per pollutant.

    The four values are named, so no extra job looks for them and all four columns exist.
    Null keys form a group of their own; drop_null_keys leaves such rows out instead.
    """
    rows = long.withColumn("value", to_double("value")).filter(
        F.col("station_id").isNotNull() & F.col("parameter").isNotNull() & (F.col("value") >= 0)
    )
    if "date" in keys:
        rows = rows.filter(F.col("date").isNotNull())
    if drop_null_keys:
        rows = rows.dropna(subset=list(keys))
    return rows.groupBy(*keys).agg(
        *[
            round_raw(F.avg(F.when(F.col("parameter") == name, F.col("value"))), 4).alias(name)
            for name in S.POLLUTANTS
        ]
    )


def stamp(df: DataFrame, source: str, run_ts: str) -> DataFrame:
    """Partition, provenance and run-time columns every Bronze row carries."""
    return df.withColumns(
        {
            "partition_date": F.col("date"),
            "ingestion_ts": F.lit(run_ts),
            "source": F.lit(source),
            "station_id": F.col("station_id").cast("string"),
        }
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """First k rows of each key. Spark cuts each map task to k rows per key before it
    shuffles, so a hot key never travels whole."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def search_stations(hits: DataFrame, k: int = S.SEARCH_HITS) -> DataFrame:
    """First k hits per search, then each station once, under its first search."""
    top = first_per_key(
        hits, ["query_order"], [F.col("position").asc(), F.col("uid").asc()], k
    )
    return top.groupBy("uid").agg(
        F.min(F.struct("query_order", "position", "country_code")).alias("first")
    ).select("uid", "first.query_order", "first.position", "first.country_code")


def locations_per_country(locations: DataFrame, k: int = S.LOCATIONS_PER_COUNTRY) -> DataFrame:
    """First k locations of each country, by station number."""
    number = F.col("station_id").try_cast("bigint")
    return first_per_key(locations, ["country_code"], [number.asc_nulls_last(), F.col("station_id").asc()], k)


def station_gaps(received: DataFrame, expected: DataFrame) -> DataFrame:
    """Stations expected but absent, or received but not expected."""
    have, want = received.select("station_id").distinct(), expected.select("station_id").distinct()
    missing = want.join(have, "station_id", "left_anti").withColumn("problem", F.lit("missing"))
    extra = have.join(want, "station_id", "left_anti").withColumn("problem", F.lit("unexpected"))
    return missing.unionByName(extra)


def require_complete(received: DataFrame, expected: DataFrame) -> DataFrame:
    """All stations or none: a partial range would mark its partitions as done for good."""
    path = scratch_path(received.sparkSession, "station-gaps")
    gaps = station_gaps(received, expected)
    gaps.write.parquet(path)
    count = received.sparkSession.read.schema(gaps.schema).parquet(path).count()
    if count:
        raise RuntimeError(f"range ingest incomplete, nothing written; {count} stations are named in {path}")
    return received
