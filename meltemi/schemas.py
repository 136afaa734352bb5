"""Canonical table schemas and the select that brings a frame into one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame

# --- fixed values: canonical column order -------------------------------------------
BRONZE_AIR = """station_id string, station_name string, city string, country_code string,
    latitude double, longitude double, pm2_5 double, pm10 double, nitrogen_dioxide double,
    ozone double, date string, partition_date string, ingestion_ts string, source string"""
SILVER_AIR = """station_id string, station_name string, city string, country_code string,
    latitude double, longitude double, date string, pm2_5 double, pm10 double,
    nitrogen_dioxide double, ozone double, pm2_5_source string, aqi_category string,
    who_pm25_exceed long, who_pm10_exceed long, who_no2_exceed long, who_o3_exceed long,
    data_completeness double, source string, silver_ts string, partition_date string"""
SILVER_WEATHER = """station_id string, station_name string, country_code string,
    latitude double, longitude double, date string, temp_max_c double, temp_min_c double,
    temp_mean_c double, apparent_temp_max_c double, precipitation_mm double,
    wind_speed_max_kmh double, wind_gust_max_kmh double, humidity_pct double,
    weather_code long, dust double, condition string, wind_level string, dust_level string,
    source string, silver_ts string, partition_date string"""

# --- raw payload schemas -------------------------------------------------------------
HOURLY_PAYLOAD = """station_id string, hourly struct<time: array<string>,
    pm2_5: array<double>, pm10: array<double>, nitrogen_dioxide: array<double>,
    ozone: array<double>, dust: array<double>>"""
DAILY_PAYLOAD = """station_id string, daily struct<time: array<string>,
    temperature_2m_max: array<double>, temperature_2m_min: array<double>,
    temperature_2m_mean: array<double>, apparent_temperature_max: array<double>,
    precipitation_sum: array<double>, wind_speed_10m_max: array<double>,
    wind_gusts_10m_max: array<double>, relative_humidity_2m_mean: array<double>,
    weather_code: array<double>>"""
LOCATIONS_PAYLOAD = """queried_country string, results array<struct<id: long, name: string,
    locality: string, country: struct<code: string>,
    coordinates: struct<latitude: double, longitude: double>,
    sensors: array<struct<id: long, parameter: struct<id: int>>>>>"""
MEASUREMENTS_PAYLOAD = """sensor_id long, results array<struct<value: double,
    period: struct<datetimeFrom: struct<utc: string>>, datetime: struct<utc: string>>>"""
FEED_PAYLOAD = """country_code string, target_date string, feed struct<idx: long,
    time: struct<v: long>, city: struct<name: string, geo: array<double>>,
    iaqi: struct<pm25: struct<v: double>, pm10: struct<v: double>, no2: struct<v: double>,
    o3: struct<v: double>>>"""
SEARCH_PAYLOAD = """query_order int, country_code string, data array<struct<uid: long,
    station: struct<name: string, geo: array<double>>>>"""

RUN_METRICS = """stage string, run_ts timestamp, rows long, duration_seconds double,
    quality_failures long"""


def canonical(df: DataFrame, ddl: str, fill: dict[str, int] | None = None) -> DataFrame:
    """One select of casts into the declared order; absent columns become typed nulls.

    Doubles are coerced (unparsable and NaN to null); `fill` gives the value that replaces
    a null in integer columns.
    """
    fill = fill or {}
    columns = []
    for name, kind in (part.split() for part in ddl.split(",")):
        if name not in df.columns:
            out = f"cast(null as {kind})"
        elif kind == "double":
            out = f"nanvl(try_cast({name} as double), cast(null as double))"
        elif kind == "long":
            out = f"try_cast({name} as bigint)"
        else:
            out = f"cast({name} as {kind})"
        if name in fill:
            out = f"coalesce({out}, cast({fill[name]} as {kind}))"
        columns.append(f"{out} as {name}")
    return df.selectExpr(*columns)
