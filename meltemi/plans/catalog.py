"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meltemi import schemas
from meltemi import settings as S
from meltemi.functions import dates
from meltemi.functions.dates import season_of
from meltemi.functions.geo import haversine_km
from meltemi.functions.numeric import round_even
from meltemi.operators import (
    anomaly, bronze, contracts, distincts, gold, grid, incremental, marts, monitoring, places, quality, silver, sinks,
)
from meltemi.operators.quantiles import group_quantiles
from meltemi.plans import brief, report, season
from meltemi.session import apply_runtime_conf, scratch_path
from meltemi.sources import landing, payloads, snapshots, tables
from meltemi.streaming import daily_means, series

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its function's name, less a trailing underscore."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(apply_runtime_conf(spark), sf_dir)

    REGISTRY[fn.__name__.rstrip("_")] = run
    return fn


# --- shared frames --------------------------------------------------------------------
def air(spark: SparkSession, d: str) -> DataFrame:
    return silver.build_air(landing.bronze_air(spark, d), landing.model_grid(spark, d), landing.RUN_TS)


def weather(spark: SparkSession, d: str) -> DataFrame:
    return silver.build_weather(landing.bronze_weather(spark, d), landing.RUN_TS)


def summary(spark: SparkSession, d: str) -> DataFrame:
    return gold.daily_country_summary(air(spark, d))


def country_weather(spark: SparkSession, d: str) -> DataFrame:
    return gold.daily_country_weather(weather(spark, d))


def flagged(spark: SparkSession, d: str) -> DataFrame:
    """Readings in the anomaly table's schema with scores SQL can repeat, so the report
    frames over that table can be compared value by value."""
    pm25, ozone = F.coalesce("pm2_5", F.lit(0.0)), F.coalesce("ozone", F.lit(0.0))
    rows = anomaly.feature_rows(air(spark, d)).select(*anomaly.OUTPUT, "latitude", "longitude")
    return rows.withColumns(
        {
            "anomaly_score": round_even(-(F.lit(0.3) + pm25 / 2000 + ozone / 2000), 6),
            "is_anomaly": ((pm25 > 150) | (ozone > 180)).cast("long"),
        }
    )


_WRITTEN: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, d: str, name: str, build: Query, by: tuple[str, ...]) -> str:
    """Path of a partitioned table written once per session from the given tables."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _WRITTEN:
        path = scratch_path(spark, name)
        sinks.append(build(spark, d), path, by)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def _gold(spark: SparkSession, d: str, name: str, build: Query) -> DataFrame:
    """A Gold table as the report reads it: stored once, partitioned by date."""
    return tables.read_table(spark, stored(spark, d, f"gold-{name}", build, sinks.DAY))


def report_summary(spark: SparkSession, d: str) -> DataFrame:
    return places.report_countries(_gold(spark, d, "summary", summary))


def report_weather(spark: SparkSession, d: str) -> DataFrame:
    return places.report_countries(_gold(spark, d, "weather", country_weather))


def risk(spark: SparkSession, d: str) -> DataFrame:
    return gold.wildfire_risk_index(air(spark, d))


def report_risk(spark: SparkSession, d: str) -> DataFrame:
    return places.report_countries(_gold(spark, d, "risk", risk))


def report_anomalies(spark: SparkSession, d: str) -> DataFrame:
    return report.model_sources(places.report_countries(_gold(spark, d, "anomalies", flagged)))


def stored_silver(spark: SparkSession, d: str) -> DataFrame:
    path = stored(spark, d, "silver-air", air, sinks.DAY_SOURCE)
    return tables.read_table(spark, path, ddl=schemas.SILVER_AIR)


# --- sources --------------------------------------------------------------------------
@query
def src_hourly_payload(spark, d):
    docs = payloads.parse_json(landing.hourly_payloads(spark, d), "body", schemas.HOURLY_PAYLOAD)
    return payloads.hourly_rows(docs)


@query
def hourly_to_daily(spark, d):
    return bronze.hourly_to_daily(src_hourly_payload(spark, d))


@query
def src_daily_weather_payload(spark, d):
    docs = payloads.parse_json(landing.daily_payloads(spark, d), "body", schemas.DAILY_PAYLOAD)
    return payloads.daily_weather_rows(docs)


@query
def src_hourly_dust(spark, d):
    docs = payloads.parse_json(landing.dust_payloads(spark, d), "body", schemas.HOURLY_PAYLOAD)
    return bronze.dust_to_daily(payloads.hourly_dust_rows(docs))


@query
def weather_dust_join(spark, d):
    days = src_daily_weather_payload(spark, d).select("station_id", "date", "temp_max_c", "weather_code")
    return bronze.attach_dust(days, src_hourly_dust(spark, d))


def _locations(spark, d):
    docs = payloads.parse_json(landing.location_payloads(spark, d), "body", schemas.LOCATIONS_PAYLOAD)
    return payloads.location_rows(docs)


@query
def src_locations(spark, d):
    return _locations(spark, d).drop("sensors")


@query
def src_sensor_params(spark, d):
    return payloads.sensor_rows(_locations(spark, d)).select("station_id", "sensor_id", "parameter")


@query
def src_daily_measurements(spark, d):
    docs = payloads.parse_json(landing.measurement_payloads(spark, d), "body", schemas.MEASUREMENTS_PAYLOAD)
    return payloads.measurement_rows(docs)


@query
def src_first_measurement(spark, d):
    docs = payloads.parse_json(landing.measurement_payloads(spark, d), "body", schemas.MEASUREMENTS_PAYLOAD)
    return payloads.first_measurement(docs)


# Where each landed payload names its subject, and the part that is broken in one of seven.
_LANDED = {
    "hourly": (landing.hourly_payloads, "$.station_id", "time"), "dust": (landing.dust_payloads, "$.station_id", "time"),
    "daily": (landing.daily_payloads, "$.station_id", "time"), "locations": (landing.location_payloads, "$.results[0].id", "results"),
    "measurements": (landing.measurement_payloads, "$.sensor_id", "results"), "feed": (landing.feed_payloads, "$.feed.idx", "feed"),
    "search": (landing.search_payloads, "$.data[0].uid", "data"),
}


def _broken(bodies, path: str, part: str):
    """Landed payloads, most of them damaged in a way that their subject decides."""
    body, n = F.col("body"), F.get_json_object("body", path).cast("long") % 7
    damaged = (
        F.when(n == 0, F.substring(body, F.lit(1), F.length(body) - 3)).when(n == 1, F.lit(" "))
        .when(n == 2, F.concat(F.lit("["), body, F.lit("]")))
        .when(n == 3, F.replace(body, F.lit(f'"{part}":'), F.lit('"was":')))
        .when(n == 4, F.replace(body, F.lit(f'"{part}":'), F.lit(f'"{part}":"x","was":')))
        .when(n == 5, F.replace(body, F.lit('"time":["'), F.lit('"time":["2024-01-01","'))).otherwise(body)
    )
    return bodies.select(damaged.alias("body"))


@query
def payload_quarantine(spark, d):
    """How many payloads of each kind become rows, and how many are set aside for which reason."""
    parts = []
    for kind, (landed, path, part) in _LANDED.items():
        good, bad = payloads.parse_or_quarantine(_broken(landed(spark, d), path, part), "body", payloads.SHAPES[kind])
        reasons = good.select(F.lit(None).cast("string").alias("reason")).unionByName(bad.select("reason"))
        parts.append(reasons.groupBy("reason").agg(F.count("*").alias("payloads")).select(F.lit(kind).alias("kind"), "reason", "payloads"))
    return reduce(DataFrame.unionByName, parts)


@query
def requested_dates(spark, d):
    """Dates of a list written by hand, one per customer group, first mention kept."""
    written = landing.table(spark, d, "orders").groupBy((F.col("o_custkey") % 20).alias("list")).agg(
        F.array_join(F.sort_array(F.collect_list(F.date_format("o_orderdate", "yyyy-MM-dd"))), ", ").alias("raw"))
    return written.select("list", F.explode(dates.date_list(F.col("raw"))).alias("partition_date"))


@query
def src_station_feed(spark, d):
    docs = payloads.parse_json(landing.feed_payloads(spark, d), "body", schemas.FEED_PAYLOAD)
    return payloads.feed_rows(docs)


def _search(spark, d):
    docs = payloads.parse_json(landing.search_payloads(spark, d), "body", schemas.SEARCH_PAYLOAD)
    return payloads.search_hits(docs)


@query
def src_station_search(spark, d):
    return places.keep_near_cities(_search(spark, d))


@query
def topk_per_key(spark, d):
    return bronze.search_stations(src_station_search(spark, d))


@query
def locations_per_country(spark, d):
    return bronze.locations_per_country(src_locations(spark, d)).select("country_code", "station_id")


@query
def openaq_pivot(spark, d):
    """Readings are pivoted under their station's number first; its attributes join after."""
    long = landing.readings(spark, d).withColumn("station_id", F.col("user_id"))
    wide = bronze.pivot_measurements(long, keys=("station_id", "date"))
    stations = landing.stations(spark, d).drop("source")
    return wide.withColumnRenamed("station_id", "user_id").join(stations, "user_id").drop("user_id")


@query
def ingest_completeness(spark, d):
    expected = landing.stations(spark, d)
    return bronze.station_gaps(landing.bronze_weather(spark, d), expected)


# --- scans ----------------------------------------------------------------------------
READING = ["station_id", "source", "partition_date", "pm2_5"]


def _stored_bronze(spark, d):
    return stored(spark, d, "bronze-air", landing.bronze_air, sinks.DAY)


@query
def scan_partition_filter(spark, d):
    wanted = F.col("partition_date").isin("2024-01-03", "2024-01-12", "2024-01-27")
    return tables.read_table(spark, _stored_bronze(spark, d), wanted).select(*READING)


@query
def scan_silver_window(spark, d):
    return tables.in_window(stored_silver(spark, d), landing.AS_OF, 14).select(*READING)


@query
def scan_non_empty(spark, d):
    """The summary as publishing reads it; an empty table would raise."""
    return tables.read_non_empty(spark, stored(spark, d, "gold-summary", summary, sinks.DAY))


@query
def dates_in_paths(spark, d):
    """Partition dates named in the paths of Silver's files."""
    path = stored(spark, d, "silver-air", air, sinks.DAY_SOURCE)
    files = spark.read.parquet(path).select(F.input_file_name().alias("path")).distinct()
    return tables.dates_in_paths(files)


@query
def scan_recent_partitions(spark, d):
    df = stored_silver(spark, d)
    recent = tables.recent_or_named(df, landing.AS_OF, 3).withColumn("read", F.lit("recent"))
    named = tables.recent_or_named(df, landing.AS_OF, 1, ["2024-01-05", "2024-01-09"])
    return recent.unionByName(named.withColumn("read", F.lit("named"))).select("read", *READING)


@query
def list_partitions(spark, d):
    return tables.partition_dates(stored_silver(spark, d))


@query
def stg_air_quality(spark, d):
    return marts.stg_air_quality(stored_silver(spark, d))


# --- Silver ---------------------------------------------------------------------------
def _raw_text(spark, d):
    """Bronze as untyped text with unparsable numbers, dates and places in it."""
    day = F.dayofmonth(F.col("date").cast("date"))
    as_text = {c: F.col(c).cast("string") for c in ("latitude", "longitude", *S.POLLUTANTS)}
    as_text["pm10"] = F.when(F.col("pm10") > 60, "n/a").otherwise(F.col("pm10").cast("string"))
    as_text["ozone"] = F.when(F.col("ozone") > 120, "NaN").otherwise(F.col("ozone").cast("string"))
    as_text["longitude"] = F.when(day == 17, "east").otherwise(F.col("longitude").cast("string"))
    as_text["date"] = F.when(day == 9, F.concat("date", F.lit("T06:00:00"))).when(
        day == 11, F.lit("2024-13-45")
    ).otherwise(F.col("date"))
    return landing.bronze_air(spark, d).drop("city").withColumns(as_text)


@query
def silver_clean(spark, d):
    return silver.clean_air(_raw_text(spark, d)).drop("partition_date", "ingestion_ts")


@query
def silver_enrich(spark, d):
    cleaned = silver.clean_air(landing.bronze_air(spark, d))
    return silver.enrich_air(cleaned, landing.RUN_TS).select(
        "station_id", "date", *S.POLLUTANTS, "data_completeness", "aqi_category", *S.WHO_FLAGS.values()
    )


@query
def silver_canonical(spark, d):
    return air(spark, d)


@query
def pm25_patch(spark, d):
    cleaned = silver.clean_air(landing.bronze_air(spark, d))
    return silver.fill_pm25(cleaned, landing.model_grid(spark, d)).select(
        "station_id", "source", "date", "latitude", "longitude", "pm2_5", "pm2_5_source"
    )


@query
def silver_union_sources(spark, d):
    # Bronze as the job finds it: stored by source, so each frame scans its own folder.
    rows = tables.read_table(spark, stored(spark, d, "bronze-air", landing.bronze_air, ("source",)))
    frames = {s: rows.filter(F.col("source") == s) for s in S.AIR_SOURCES}
    frames["openmeteo"] = frames["openmeteo"].drop("city")
    return silver.union_sources(frames, landing.model_grid(spark, d), landing.RUN_TS)


@query
def weather_clean(spark, d):
    return silver.clean_weather(landing.bronze_weather(spark, d)).drop("partition_date", "ingestion_ts")


@query
def weather_enrich(spark, d):
    return weather(spark, d)


@query
def air_weather_join(spark, d):
    joined = silver.air_with_weather(air(spark, d), weather(spark, d))
    return joined.select(
        "station_id", "date", "source", "pm2_5", "ozone", "temp_max_c", "temp_min_c", "condition",
        "wind_level", "dust_level",
    )


@query
def incremental_partitions(spark, d):
    """Partitions left to do when Silver holds each source up to a different day."""
    bronze_air = landing.bronze_air(spark, d)
    done = F.when(F.col("source") == "openmeteo", "2024-01-20").when(F.col("source") == "openaq", "2024-01-25").otherwise("2024-01-02")
    held = air(spark, d).filter(F.col("partition_date") <= done)
    return incremental.unprocessed_partitions(bronze_air, held)


@query
def changed_partitions(spark, d):
    """Bronze landed again: every third date with other rows in one source, every other in another order, new dates."""
    now = landing.bronze_air(spark, d)
    day = F.day(F.col("partition_date").cast("date"))
    before = now.filter("partition_date < '2024-01-25'").withColumn(
        "ozone", F.when((day % 3 == 0) & (F.col("source") == "openaq"), F.col("ozone") + 1).otherwise(F.col("ozone")))
    again = now.orderBy("station_id").repartition(7).unionByName(now.filter("partition_date = '2024-01-02' and source = 'waqi'"))
    return incremental.changed_partitions(incremental.fingerprints(again), incremental.fingerprints(before))


@query
def missing_dates(spark, d):
    held = air(spark, d).filter((F.col("partition_date") <= "2024-01-10") | (F.col("partition_date") > "2024-01-15"))
    return incremental.missing_dates(spark, held, "2023-12-28", "2024-02-03")


# --- Gold -----------------------------------------------------------------------------
@query
def daily_country_summary(spark, d):
    return summary(spark, d)


@query
def wildfire_risk_index(spark, d):
    return risk(spark, d)


@query
def trailing_quantile(spark, d):
    days = gold.flag_heat_events(weather(spark, d))
    return days.select(
        "station_id", "partition_date",
        round_even("heat_baseline_c", 6).alias("heat_baseline_c"),
        round_even("cold_baseline_c", 6).alias("cold_baseline_c"),
    )


@query
def heat_streak(spark, d):
    """Streaks over years of supplier ship dates."""
    days = gold.flag_heat_events(landing.weather_history(spark, d))
    return days.select(
        "station_id", "partition_date", "is_hot_day", "is_cold_day", "heat_streak_days", "cold_streak_days"
    )


@query
def flag_heat_events(spark, d):
    days = gold.flag_heat_events(weather(spark, d))
    return days.select(
        "station_id", "partition_date", "temp_max_c", "temp_min_c", "is_hot_day", "is_cold_day",
        "heat_streak_days", "cold_streak_days",
    )


@query
def repeated_station_days(spark, d):
    """Station-days of the weather that came more than once, of which the baselines see one."""
    rows = weather(spark, d)
    again = rows.filter("substring(station_id, 3, 1) = '7'").withColumn("temp_max_c", F.col("temp_max_c") + 1)
    return gold.repeated_days(rows.unionByName(again).unionByName(rows.filter("partition_date = '2024-01-09'")))


@query
def daily_country_weather(spark, d):
    return country_weather(spark, d)


@query
def anomaly_features(spark, d):
    rows = anomaly.established_rows(anomaly.feature_rows(stored_silver(spark, d)).select(*anomaly.OUTPUT))
    return anomaly.impute(rows).select(
        "station_id", "source", "date", *[round_even(f, 6).alias(f"model{f}") for f in anomaly.FILLED]
    )


@query
def anomaly_alerts(spark, d):
    return anomaly.anomaly_alerts(stored_silver(spark, d))


@query
def mart_daily_air_quality(spark, d):
    return marts.mart_daily_air_quality(marts.stg_air_quality(air(spark, d)))


@query
def mart_city_weekly_trend(spark, d):
    return marts.mart_city_weekly_trend(marts.stg_air_quality(air(spark, d)))


@query
def mart_source_coverage(spark, d):
    return marts.mart_source_coverage(marts.stg_air_quality(air(spark, d)))


@query
def mart_who_exceedance_streak(spark, d):
    return marts.mart_who_exceedance_streak(marts.stg_air_quality(air(spark, d)))


# --- sinks ----------------------------------------------------------------------------
@query
def sink_append_roundtrip(spark, d):
    """Two appends, the second with a column the first does not have."""
    path = scratch_path(spark, "append")
    rows = landing.bronze_air(spark, d).drop("ingestion_ts")
    sinks.append(rows.filter("source = 'openmeteo'").drop("city"), path)
    sinks.append(rows.filter("source <> 'openmeteo'"), path)
    return tables.read_table(spark, path, merge=True)


@query
def sink_replace_range(spark, d):
    """A rebuilt range in which one date has no rows any more."""
    path = scratch_path(spark, "replace")
    rows = landing.bronze_weather(spark, d).select("station_id", "partition_date", "temp_max_c", "temp_min_c")
    sinks.append(rows, path, sinks.DAY)
    fresh = rows.filter("partition_date <> '2024-01-14'").withColumn("temp_max_c", F.col("temp_max_c") + 1)
    sinks.replace_range(fresh, path, "2024-01-13", "2024-01-16")
    return tables.read_table(spark, path)


@query
def sink_overwrite(spark, d):
    """A rebuild replaces every row, and partitions only the old table had are gone."""
    path = scratch_path(spark, "overwrite")
    old = landing.bronze_weather(spark, d).select("station_id", "partition_date", "temp_max_c")
    sinks.append(old, path, sinks.DAY)
    sinks.overwrite(summary(spark, d).filter("partition_date > '2024-01-02'"), path)
    return tables.read_table(spark, path)


def _older_run(spark, d):
    """The summary as an earlier run left it: other figures, two dates lost."""
    old = summary(spark, d).withColumn("mean_pm2_5", F.lit(-1.0))
    return old.filter("partition_date not in ('2024-01-08', '2024-01-28')")


@query
def gold_merge_refreshed(spark, d):
    first = tables.cutoff(landing.AS_OF, S.REFRESH_DAYS)
    return incremental.merge_refreshed(_older_run(spark, d), summary(spark, d), first)


@query
def gold_refresh(spark, d):
    """The same splice as a write: only the refreshed partitions are touched."""
    path = scratch_path(spark, "refresh")
    sinks.append(_older_run(spark, d), path, sinks.DAY)
    sinks.refresh(summary(spark, d), path, landing.AS_OF)
    return tables.read_table(spark, path)


def _versioned(spark, d):
    """An older run, a refresh, a rebuilt range two of whose dates have no rows any more, and the way back to the refresh."""
    path = scratch_path(spark, "versions")
    sinks.overwrite(_older_run(spark, d), path)
    sinks.refresh(summary(spark, d), path, landing.AS_OF)
    sinks.replace_range(summary(spark, d).filter("partition_date = '2024-01-21'"), path, "2024-01-20", "2024-01-22")
    sinks.restore(spark, path, 2)
    return path


@query
def table_history(spark, d):
    return snapshots.history(spark, _versioned(spark, d)).drop("written_at")


@query
def table_as_of_version(spark, d):
    """Every version as it was, read after the last one was written."""
    path = _versioned(spark, d)
    return reduce(DataFrame.unionByName, [
        tables.read_table(spark, path, version=n).select(
            F.lit(n).alias("version"), "partition_date", "country_code", "source", "mean_pm2_5") for n in (1, 2, 3)])


@query
def table_restore(spark, d):
    return tables.read_table(spark, _versioned(spark, d))


@query
def readiness_diagnostics(spark, d):
    return report.readiness_diagnostics(report_summary(spark, d), report_anomalies(spark, d))


@query
def brief_facts(spark, d):
    facts = brief.latest_country_facts(report_summary(spark, d), report_weather(spark, d))
    return brief.facts_json(facts)


# --- geography ------------------------------------------------------------------------
@query
def geo_haversine(spark, d):
    first = S.CITY_ANCHORS["TN"][0]
    km = haversine_km(F.col("latitude"), F.col("longitude"), F.lit(first[0]), F.lit(first[1]))
    return landing.stations(spark, d).select("station_id", round_even(km, 4).alias("km"))


@query
def geo_near_city(spark, d):
    near = places.near_known_city(F.col("latitude"), F.col("longitude"), F.col("country_code"))
    return landing.stations(spark, d).select("station_id", near.alias("near"))


def _anchor_table(spark, d):
    """Every fifth station as an anchor of its country."""
    return landing.stations(spark, d).filter("user_id % 5 = 0").select(
        F.col("user_id").alias("anchor_id"), F.upper(F.substring_index("station_id", "_", -1)).alias("country_code"), "latitude", "longitude")


@query
def geo_near_anchors(spark, d):
    """Station-days within 25 km of an anchor of their country, with the anchors as a table."""
    rows = air(spark, d).select("station_id", "date", "country_code", "latitude", "longitude")
    return grid.keep_near_anchors(rows, _anchor_table(spark, d), max_km=25.0).select("station_id", "date", "country_code")


@query
def geo_nearest_anchor(spark, d):
    return grid.nearest_anchor(landing.stations(spark, d), "station_id", _anchor_table(spark, d), max_km=60.0)


@query
def report_filter(spark, d):
    return places.report_countries(air(spark, d)).select("station_id", "source", "date", "country_code")


# --- distinct counts that add up ------------------------------------------------------
def _bitmaps(spark, d):
    """Stored station bitmaps of all days, a third of which were refreshed after the first build."""
    key = (spark.sparkContext.applicationId, d, "bitmaps")
    if key not in _WRITTEN:
        root, rows = scratch_path(spark, "bitmaps"), stored_silver(spark, d)
        distincts.refresh(spark, rows.filter("partition_date < '2024-01-25' and station_id not like '%7_%'"), root)
        distincts.refresh(spark, rows, root, "2024-01-01", "2024-01-20")
        distincts.refresh(spark, rows.filter("partition_date > '2024-01-20'"), root, "2024-01-21", None)
        _WRITTEN[key] = root
    return distincts.stored(spark, _WRITTEN[key])


@query
def stations_by_week(spark, d):
    return distincts.roll_up(_bitmaps(spark, d), week=distincts.week(), country_code=F.col("country_code"))


@query
def stations_by_month(spark, d):
    """Per month by country and source, by country, and in all, in one pass over the bitmaps."""
    columns = {"month": distincts.month(), "country_code": F.col("country_code"), "source": F.col("source")}
    return distincts.roll_up_sets(_bitmaps(spark, d), [["month", "country_code", "source"], ["month", "country_code"], ["month"]], **columns)


# --- report ---------------------------------------------------------------------------
@query
def coverage_by_date(spark, d):
    return report.coverage_by_date(report_summary(spark, d))


@query
def coverage_readiness(spark, d):
    return report.mark_readiness(report.coverage_by_date(report_summary(spark, d)))


@query
def reporting_dates(spark, d):
    return report.reporting_dates(report_summary(spark, d))


@query
def latest_reporting_dates(spark, d):
    return report.latest_reporting_dates(report_summary(spark, d), 20)


@query
def anomaly_daily_rates(spark, d):
    return report.anomaly_daily_rates(flagged(spark, d))


@query
def anomaly_by_country(spark, d):
    dates = report.latest_reporting_dates(report_summary(spark, d))
    return report.anomaly_by_country(report.on_dates(report_anomalies(spark, d), dates))


@query
def top_anomalies(spark, d):
    dates = report.latest_reporting_dates(report_summary(spark, d))
    return report.top_anomalies(report.on_dates(report_anomalies(spark, d), dates)).select(
        "partition_date", "station_id", "country_code", "anomaly_score"
    )


def _thin_summary(spark, d):
    """The summary with its newest date barely covered, so that the date is not ready to report."""
    rows = report_summary(spark, d)
    newest = rows.agg(F.max("partition_date")).scalar()
    thin = F.when(F.col("partition_date") == newest, F.lit(1).cast("long")).otherwise(F.col("station_count"))
    return rows.withColumn("station_count", thin)


def _shown(spark, d):
    return report.latest_reporting_dates(_thin_summary(spark, d))


@query
def anomaly_audit(spark, d):
    """The forest's output held against what must be true of it, row by row.

    Scores lie between -1 and 0, and the flag is that of the exact 5th percentile of the scores
    as stored; a score that rounds to the percentile itself may have either.
    """
    scored = tables.read_table(spark, stored(spark, d, "forest", lambda s, e: anomaly.anomaly_alerts(air(s, e)), sinks.DAY))
    bar = group_quantiles(scored, [], "anomaly_score", S.CONTAMINATION, "bar", *anomaly.SCORE_SPAN, few_groups=True).scalar()
    score = F.col("anomaly_score")
    follows = ((F.col("is_anomaly") == 1) == (score < bar)) | (F.abs(score - bar) < 2e-6)
    return scored.select(
        "station_id", "source", "date", "pm2_5", "ozone", "nitrogen_dioxide",
        score.between(-1, 0).alias("score_in_range"), follows.alias("flag_follows_scores"))


@query
def forest_daily_rates(spark, d):
    """Readings the forest scored per date, as the report counts them."""
    scored = tables.read_table(spark, stored(spark, d, "forest", lambda s, e: anomaly.anomaly_alerts(air(s, e)), sinks.DAY))
    return report.anomaly_daily_rates(scored).select("partition_date", "rows")


@query
def most_anomalous_of_day(spark, d):
    rows = report.most_anomalous(report_anomalies(spark, d), _shown(spark, d))
    return rows.select("partition_date", "station_id", "anomaly_score", "is_anomaly")


@query
def score_histogram(spark, d):
    return report.score_histogram(report_anomalies(spark, d), _shown(spark, d))


@query
def day_value_histogram(spark, d):
    return report.day_value_histogram(report_anomalies(spark, d), _shown(spark, d))


@query
def top_anomaly_facts(spark, d):
    newest = report_summary(spark, d).agg(F.max("partition_date")).first()[0]
    return brief.top_anomaly_facts(report_anomalies(spark, d), report_weather(spark, d), newest)


@query
def spotlight(spark, d):
    return brief.spotlight(report_weather(spark, d), "2024-01-29").select(
        "country_code", "date", "season", "focus", "measured", "leader", "rank_days", "unit", "value"
    )


def _long(pivoted: DataFrame, value: str) -> DataFrame:
    """A pivot with a row per cell, since its columns depend on the data."""
    countries = [c for c in pivoted.columns if c != "partition_date"]
    return pivoted.unpivot("partition_date", countries, "country_code", value)


@query
def coverage_pivot(spark, d):
    rows = report_summary(spark, d)
    pivoted = report.coverage_pivot(rows, report.latest_reporting_dates(rows))
    return _long(pivoted, "station_days")


@query
def pollutants_by_country(spark, d):
    return report.pollutants_by_country(report_summary(spark, d))


@query
def who_exceed_by_country(spark, d):
    return report.who_exceed_by_country(report_summary(spark, d))


@query
def top_exceedance(spark, d):
    return report.top_exceedance(report_summary(spark, d))


@query
def risk_distribution(spark, d):
    return report.risk_distribution(report_risk(spark, d))


@query
def top_risk(spark, d):
    return report.top_risk(report_risk(spark, d)).select(
        "partition_date", "station_id", "country_code", "risk_index", "risk_level"
    )


@query
def source_share(spark, d):
    return report.source_share(report_summary(spark, d))


@query
def focus_pivot(spark, d):
    dates = report.latest_reporting_dates(report_summary(spark, d))
    rows = report_weather(spark, d)
    return _long(report.focus_pivot(rows, dates, season.latest_focus(rows)), "value")


@query
def latest_conditions(spark, d):
    rows = report_weather(spark, d)
    return report.latest_conditions(rows, season.latest_focus(rows))


@query
def report_kpis(spark, d):
    return report.report_kpis(
        report_summary(spark, d), report_risk(spark, d), report_anomalies(spark, d), report_weather(spark, d)
    )


@query
def country_briefing_facts(spark, d):
    return brief.latest_country_facts(report_summary(spark, d), report_weather(spark, d))


@query
def weather_profile(spark, d):
    return brief.weather_profile(report_weather(spark, d), "2024-01-29")


# --- season ---------------------------------------------------------------------------
@query
def season_of_(spark, d):
    return (
        landing.table(spark, d, "orders")
        .groupBy(season_of(F.to_date("o_orderdate")).alias("season"), F.month("o_orderdate").alias("month"))
        .agg(F.count("*").alias("orders"))
    )


@query
def season_focus(spark, d):
    return season.focus_by_day(report_weather(spark, d))


@query
def season_event_days(spark, d):
    return season.event_days(report_weather(spark, d), *season.FOCI.values())


@query
def rank_countries(spark, d):
    ranked = season.rank_all(report_weather(spark, d), "2024-01-28")
    return ranked.select("focus", "country_code", round_even("value", 6).alias("value"))


# --- quality, audits, contracts -------------------------------------------------------
@query
def quality_bronze(spark, d):
    rows = landing.bronze_air(spark, d)
    parts = [quality.bronze_suite(rows.filter(F.col("source") == s), s) for s in S.AIR_SOURCES]
    return reduce(DataFrame.unionByName, parts)


def _faulty_silver(spark, d):
    """Silver with a foreign source, an unknown tier and rows under the floor planted in it."""
    return air(spark, d).withColumns(
        {
            "source": F.when(F.col("pm2_5") > 400, "handheld").otherwise(F.col("source")),
            "aqi_category": F.when(F.col("ozone") > 200, "foul").otherwise(F.col("aqi_category")),
            "data_completeness": F.when(F.col("pm10") > 150, 0.1).otherwise(F.col("data_completeness")),
            "who_no2_exceed": F.when(F.col("pm10") > 200, 2).otherwise(F.col("who_no2_exceed")),
            "pm10": F.when(F.col("pm10") < 2, -F.col("pm10")).otherwise(F.col("pm10")),
        }
    ).drop("silver_ts")


@query
def quality_silver(spark, d):
    return quality.silver_suite(_faulty_silver(spark, d))


@query
def quality_weather(spark, d):
    raw = landing.bronze_weather(spark, d)
    clean = weather(spark, d).withColumn(
        "condition", F.when(F.col("dust") > 100, "sandstorm").otherwise(F.col("condition"))
    )
    first = quality.weather_suite(raw, "bronze", f"bronze/{S.WEATHER_SOURCE}/weather")
    return first.unionByName(quality.weather_suite(clean, "silver", "silver/weather"))


@query
def quality_checks(spark, d):
    """The whole run over the newest two partitions; one source has no data there."""
    dates = ["2024-01-29", "2024-01-30"]

    def recent(df):
        return tables.recent_or_named(df, landing.AS_OF, dates=dates)

    rows = recent(landing.bronze_air(spark, d))
    frames = {s: rows.filter(F.col("source") == s) for s in S.AIR_SOURCES}
    frames["waqi"] = tables.recent_or_named(landing.bronze_air(spark, d), landing.AS_OF, dates=["2023-12-01"])
    return quality.all_suites(
        frames, recent(air(spark, d)), recent(landing.bronze_weather(spark, d)), recent(weather(spark, d)), dates
    )


@query
def quality_summary(spark, d):
    results = quality_bronze(spark, d).unionByName(quality_silver(spark, d)).unionByName(quality_weather(spark, d))
    return quality.summarise(results)


def _audited(kind: str):
    def run(spark, d):
        faulty = _faulty_silver(spark, d).withColumn("silver_ts", F.lit(landing.RUN_TS))
        stg = marts.stg_air_quality(faulty)
        chosen = [a for a in marts.AUDITS["stg_air_quality"] if a.kind == kind]
        return quality.audit(stg, "stg_air_quality", chosen)

    return run


@query
def audit_not_null(spark, d):
    return _audited("not_null")(spark, d)


@query
def audit_accepted_values(spark, d):
    return _audited("accepted_values")(spark, d)


@query
def audit_accepted_range(spark, d):
    return _audited("accepted_range")(spark, d)


def _mart_audit(name: str):
    """All audits of one mart, built over Silver with planted faults; every third row lacks its time stamp."""
    def run(spark, d):
        faulty = _faulty_silver(spark, d).withColumn("silver_ts", F.lit(landing.RUN_TS))
        mart = marts.MARTS[name](marts.stg_air_quality(faulty))
        stamped = marts.with_mart_ts(mart, landing.RUN_TS)
        kept = F.when(F.day("observation_date") % 3 != 0, F.col("mart_ts"))
        return quality.audit(stamped.withColumn("mart_ts", kept), name, marts.AUDITS[name])

    return run


for _name in marts.MARTS:
    _run = _mart_audit(_name)
    _run.__name__ = f"audit_{_name}"
    query(_run)


@query
def audit_unique(spark, d):
    """Readings double-booked by re-dating show up as repeated event keys."""
    rows = landing.readings(spark, d)
    keys = [quality.Audit("unique", "user_id,date,parameter"), quality.Audit("unique", "user_id,ts")]
    return quality.audit(rows, "readings", keys)


def _faulty_gold(spark, d):
    """The Gold tables with planted faults."""
    faulty_summary = summary(spark, d).withColumn(
        "mean_pm2_5", F.when(F.col("country_code") == "TN", -F.col("mean_pm2_5")).otherwise(F.col("mean_pm2_5"))
    ).drop("mean_o3")
    faulty_risk = risk(spark, d).withColumns(
        {
            "risk_index": F.col("risk_index") * 2,
            "risk_level": F.when(F.col("pm2_5").isNull(), "unset").otherwise(F.col("risk_level")),
        }
    )
    faulty_weather = country_weather(spark, d).withColumns(
        {
            "temp_max_c": F.when(F.col("wind_level") == "storm", F.col("temp_min_c") - 70).otherwise(F.col("temp_max_c")),
            "heat_alert": F.when(F.col("dust") > 150, "scorching").otherwise(F.col("heat_alert")),
            "heat_streak_days": F.col("heat_streak_days") - 1,
        }
    )
    faulty_anomalies = flagged(spark, d).withColumns(
        {
            "source": F.when(F.col("ozone") > 100, "waqi").otherwise(F.col("source")),
            "is_anomaly": F.when(F.col("pm2_5") > 300, 2).otherwise(F.col("is_anomaly")),
        }
    )
    return {
        "daily_country_summary": faulty_summary, "wildfire_risk_index": faulty_risk,
        "daily_country_weather": faulty_weather, "anomaly_alerts": faulty_anomalies,
    }


@query
def contract_checks(spark, d):
    """All four contracts over Gold tables with planted faults."""
    frames = _faulty_gold(spark, d)
    parts = [contracts.check_contract(df, contracts.CONTRACTS[name]) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


@query
def contract_documents(spark, d):
    """The same by rules as rows, read from the contract documents."""
    frames = _faulty_gold(spark, d)
    return contracts.check_rules(frames, contracts.rule_rows(spark, contracts.CONTRACTS))


@query
def contract_missing_partitions(spark, d):
    """Dates of the run log the summary has no partition for."""
    wanted = landing.run_metrics(spark, d).select(
        F.explode(F.array(F.col("run_ts"), F.date_sub("run_ts", 3).cast("timestamp"))).alias("t")
    ).select(F.col("t").cast("date").cast("string").alias("partition_date"))
    return contracts.missing_partitions(summary(spark, d), wanted)


@query
def quality_alerts(spark, d):
    """One alert per failed check and layer."""
    results = quality_bronze(spark, d).unionByName(quality_silver(spark, d)).unionByName(quality_weather(spark, d))
    return monitoring.quality_alerts(quality.failures(results))


@query
def run_metrics(spark, d):
    """Rows per stage and partition of one run."""
    parts = [
        monitoring.partition_metrics(landing.bronze_air(spark, d), "bronze"),
        monitoring.partition_metrics(air(spark, d), "silver"),
        monitoring.partition_metrics(summary(spark, d), "gold"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def run_alerts(spark, d):
    return monitoring.run_alerts(landing.run_metrics(spark, d), "2024-02-01 02:00:00")


@query
def alert_intervals(spark, d):
    return monitoring.alert_intervals(landing.run_metrics(spark, d), "2024-02-01 02:00:00")


# --- streaming ------------------------------------------------------------------------
@query
def stream_daily_means(spark, d):
    """Event stream to daily means, drained once, open days included."""
    events = landing.table(spark, d, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{d}/events*.parquet")
    out = scratch_path(spark, "stream")
    daily_means.write_daily_means(_hours(stream), out, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return tables.read_table(spark, out)


@query
def stream_late_readings(spark, d):
    """The same in three batches: the newest days, then the oldest, then the rest, days of which were there before."""
    events = landing.table(spark, d, "events")
    newest = F.col("ts") >= F.lit("2024-01-20").cast("timestamp")
    oldest = F.col("ts") < F.lit("2024-01-08").cast("timestamp")
    odd = F.col("user_id") % 2 == 1
    inbox, out, checkpoint = (scratch_path(spark, n) for n in ("late-inbox", "late", "late-checkpoint"))
    for landed in (newest & odd, oldest, ~oldest & ~(newest & odd)):
        events.filter(landed).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(events.schema).parquet(inbox)
        daily_means.write_daily_means(_hours(stream), out, checkpoint).awaitTermination()
    return tables.read_table(spark, out)


def _hours(stream):
    value = {
        name: F.when(F.col("event_type") == event, F.col("value"))
        for event, name in landing.EVENT_POLLUTANT.items()
        if name in S.POLLUTANTS
    }
    return stream.select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").cast("string").alias("station_id"), *[c.alias(n) for n, c in value.items()]
    )


def _in_batches(spark, name, rows, batches, processor):
    """Rows land in the given batches, and a stream takes each as it comes."""
    staged, inbox, out, checkpoint = (scratch_path(spark, f"{name}-{n}") for n in ("staged", "inbox", "out", "checkpoint"))
    # Made once, and not for each batch.
    rows.write.parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    for landed in batches:
        rows.filter(landed).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(rows.schema).parquet(inbox)
        series.write_judged(stream, processor, out, checkpoint).awaitTermination()
    return tables.read_table(spark, out)


@query
def stream_heat_events(spark, d):
    """Hot and cold days from state: most days, the newest ones, then those between that came late."""
    rows = weather(spark, d).select("station_id", "partition_date", "temp_max_c", "temp_min_c")
    late = F.col("partition_date").between("2024-01-14", "2024-01-16")
    newest = F.col("partition_date") > "2024-01-24"
    days = _in_batches(spark, "heat", rows, (~late & ~newest, newest, late), series.HeatEvents())
    return days.drop("heat_baseline_c", "cold_baseline_c")


@query
def stream_exceedance_streak(spark, d):
    """Exceedance streaks from state, of days that land from the newest to the oldest third."""
    stg = marts.stg_air_quality(air(spark, d))
    rows = stg.groupBy("observation_date", "station_id", "station_name", "country_code", "source").agg(
        *[F.max(f).alias(f) for f in S.WHO_FLAGS.values()])
    date = F.col("observation_date").cast("string")
    batches = (date > "2024-01-20", date <= "2024-01-10", (date > "2024-01-10") & (date <= "2024-01-20"))
    days = _in_batches(spark, "exceedance", rows, batches, series.Exceedances())
    return days.select("observation_date", "station_id", "station_name", "country_code", "source", "current_exceedance_streak_days")
