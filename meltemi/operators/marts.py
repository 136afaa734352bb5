"""The four typed marts over Silver air quality, and their audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meltemi import settings as S
from meltemi.functions.numeric import round_up
from meltemi.operators.quality import Audit


def stg_air_quality(silver: DataFrame) -> DataFrame:
    """Typed projection of Silver; text dates become dates, flags become ints."""
    doubles = ["latitude", "longitude", *S.POLLUTANTS]
    return silver.filter(F.col("station_id").isNotNull()).select(
        "station_id", "station_name", "city", "country_code",
        F.col("date").cast("date").alias("observation_date"),
        *[F.col(c).cast("double").alias(c) for c in doubles],
        "aqi_category",
        *[F.col(c).cast("int").alias(c) for c in S.WHO_FLAGS.values()],
        F.col("data_completeness").cast("double").alias("data_completeness"),
        "source", "partition_date", F.col("silver_ts").alias("_loaded_at"),
    )


def _share(condition, digits: int = 1):
    return round_up(F.avg(F.when(condition, 1.0).otherwise(0.0)) * 100, digits)


def mart_daily_air_quality(stg: DataFrame) -> DataFrame:
    return stg.groupBy(
        "observation_date", "country_code", "source", F.col("aqi_category").alias("dominant_aqi_tier")
    ).agg(
        F.countDistinct("station_id").alias("station_count"),
        round_up(F.avg("pm2_5"), 2).alias("daily_mean_pm2_5"),
        round_up(F.max("pm2_5"), 2).alias("daily_max_pm2_5"),
        round_up(F.avg("pm10"), 2).alias("daily_mean_pm10"),
        round_up(F.avg("nitrogen_dioxide"), 2).alias("daily_mean_nitrogen_dioxide"),
        round_up(F.avg("ozone"), 2).alias("daily_mean_ozone"),
        *[round_up(F.avg(flag) * 100, 1).alias(f"{flag}_pct") for flag in S.WHO_FLAGS.values()],
        round_up(F.avg("data_completeness"), 4).alias("mean_data_completeness"),
    )


def mart_city_weekly_trend(stg: DataFrame) -> DataFrame:
    """City-day means and their seven-row rolling means.

    The window runs on city-days, one row per city, source and date, after the aggregate.
    """
    city = F.coalesce(F.nullif("city", F.lit("")), "station_name", "station_id")
    daily = stg.groupBy("observation_date", "country_code", city.alias("city_name"), "source").agg(
        F.countDistinct("station_id").alias("station_count"),
        round_up(F.avg("pm2_5"), 2).alias("daily_mean_pm2_5"),
        round_up(F.avg("ozone"), 2).alias("daily_mean_ozone"),
        round_up(F.avg("data_completeness"), 4).alias("mean_data_completeness"),
    )
    week = (
        Window.partitionBy("country_code", "city_name", "source")
        .orderBy("observation_date")
        .rowsBetween(-6, 0)
    )
    return daily.withColumns(
        {
            "rolling_7d_pm2_5": round_up(F.avg("daily_mean_pm2_5").over(week), 2),
            "rolling_7d_ozone": round_up(F.avg("daily_mean_ozone").over(week), 2),
        }
    ).select(
        "observation_date", "country_code", "city_name", "source", "station_count",
        "daily_mean_pm2_5", "daily_mean_ozone", "rolling_7d_pm2_5", "rolling_7d_ozone",
        "mean_data_completeness",
    )


def mart_source_coverage(stg: DataFrame) -> DataFrame:
    return stg.groupBy("observation_date", "country_code", "source").agg(
        F.countDistinct("station_id").alias("station_count"),
        F.count("*").alias("reading_count"),
        round_up(F.avg("data_completeness"), 4).alias("mean_data_completeness"),
        _share(F.col("pm2_5").isNotNull()).alias("pm2_5_available_pct"),
        _share(F.col("pm10").isNotNull()).alias("pm10_available_pct"),
        _share(F.col("nitrogen_dioxide").isNotNull()).alias("no2_available_pct"),
        _share(F.col("ozone").isNotNull()).alias("ozone_available_pct"),
    )


def mart_who_exceedance_streak(stg: DataFrame) -> DataFrame:
    """Consecutive station-days with at least one guideline exceeded."""
    flags = list(S.WHO_FLAGS.values())
    days = stg.groupBy("observation_date", "station_id", "station_name", "country_code", "source").agg(
        *[F.max(flag).alias(flag) for flag in flags]
    )
    exceeded = F.coalesce(F.greatest(*flags) == 1, F.lit(False)).cast("int")
    series = Window.partitionBy("station_id", "source").orderBy(
        "observation_date", "station_name", "country_code"
    )
    running = series.rowsBetween(Window.unboundedPreceding, 0)
    row = F.row_number().over(series)
    clean_row = F.max(F.when(F.col("has_who_exceedance") == 0, F.col("_row"))).over(running)
    return (
        days.withColumn("has_who_exceedance", exceeded)
        .withColumn("_row", row)
        .withColumn(
            "current_exceedance_streak_days",
            (F.col("_row") - F.coalesce(clean_row, F.lit(0))).cast("long"),
        )
        .drop("_row")
    )


MARTS = {
    "mart_daily_air_quality": mart_daily_air_quality,
    "mart_city_weekly_trend": mart_city_weekly_trend,
    "mart_source_coverage": mart_source_coverage,
    "mart_who_exceedance_streak": mart_who_exceedance_streak,
}


def with_mart_ts(df: DataFrame, run_ts: str) -> DataFrame:
    return df.withColumn("mart_ts", F.lit(run_ts).cast("timestamp"))


# --- fixed values: audits of the staging view and the marts ---------------------------
_SOURCE = Audit("accepted_values", "source", values=S.AIR_SOURCES)
AUDITS = {
    "stg_air_quality": (
        *[Audit("not_null", c) for c in (
            "station_id", "country_code", "observation_date", "latitude", "longitude",
            "aqi_category", "data_completeness", "source", "partition_date", "_loaded_at")],
        Audit("unique", "station_id,observation_date,source"),
        Audit("accepted_range", "latitude", low=-90, high=90),
        Audit("accepted_range", "longitude", low=-180, high=180),
        *[Audit("accepted_range", c, low=0, high=S.POLLUTANT_MAX[c]) for c in S.POLLUTANTS],
        Audit("accepted_range", "data_completeness", low=0, high=1),
        Audit("accepted_values", "aqi_category", values=S.AQI_LABELS),
        *[Audit("accepted_values", c, values=(0, 1)) for c in S.WHO_FLAGS.values()],
        _SOURCE,
    ),
    "mart_daily_air_quality": (
        *[Audit("not_null", c) for c in (
            "observation_date", "country_code", "source", "dominant_aqi_tier", "station_count",
            "mean_data_completeness", "mart_ts")],
        Audit("unique", "observation_date,country_code,source,dominant_aqi_tier"),
        _SOURCE,
        Audit("accepted_values", "dominant_aqi_tier", values=S.AQI_LABELS),
        Audit("accepted_range", "station_count", low=1),
        Audit("accepted_range", "daily_mean_pm2_5", low=0, high=1000),
        Audit("accepted_range", "daily_max_pm2_5", low=0, high=1000),
        Audit("accepted_range", "daily_mean_pm10", low=0, high=2000),
        Audit("accepted_range", "daily_mean_nitrogen_dioxide", low=0, high=500),
        Audit("accepted_range", "daily_mean_ozone", low=0, high=500),
        *[Audit("accepted_range", f"{c}_pct", low=0, high=100) for c in S.WHO_FLAGS.values()],
        Audit("accepted_range", "mean_data_completeness", low=0, high=1),
    ),
    "mart_city_weekly_trend": (
        *[Audit("not_null", c) for c in (
            "observation_date", "country_code", "city_name", "source", "station_count", "mart_ts")],
        _SOURCE,
        Audit("accepted_range", "station_count", low=1),
        Audit("accepted_range", "rolling_7d_pm2_5", low=0, high=1000),
        Audit("accepted_range", "rolling_7d_ozone", low=0, high=500),
    ),
    "mart_source_coverage": (
        *[Audit("not_null", c) for c in (
            "observation_date", "country_code", "source", "station_count", "mean_data_completeness", "mart_ts")],
        _SOURCE,
        Audit("accepted_range", "station_count", low=1),
        Audit("accepted_range", "mean_data_completeness", low=0, high=1),
        Audit("accepted_range", "pm2_5_available_pct", low=0, high=100),
    ),
    "mart_who_exceedance_streak": (
        *[Audit("not_null", c) for c in (
            "observation_date", "station_id", "country_code", "source",
            "current_exceedance_streak_days", "mart_ts")],
        _SOURCE,
        Audit("accepted_values", "has_who_exceedance", values=(0, 1)),
        Audit("accepted_range", "current_exceedance_streak_days", low=0),
    ),
}
