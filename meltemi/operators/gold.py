"""Silver to Gold: country summary, wildfire risk, heat and cold events, country weather."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meltemi import settings as S
from meltemi.functions.labels import risk_level, worst
from meltemi.functions.numeric import clip, round_even
from meltemi.operators.series import with_streak, with_trailing_quantiles


def with_country(df: DataFrame) -> DataFrame:
    """A blank country code is the last token of the station id, upper-cased; without the column it is null."""
    if "country_code" not in df.columns:
        return df.withColumn("country_code", F.lit(None).cast("string"))
    suffix = F.upper(F.element_at(F.split("station_id", "_"), -1))
    return df.withColumn("country_code", F.coalesce("country_code", suffix))


def daily_country_summary(silver: DataFrame) -> DataFrame:
    """Daily mean, peak and exceedance share per country and source.

    Spark aggregates the single distinct count in two steps, first by station inside each
    group and then by group, so one busy country is spread over many tasks.
    """
    figures = {
        "mean_pm2_5": F.avg("pm2_5"),
        "max_pm2_5": F.max("pm2_5"),
        "mean_pm10": F.avg("pm10"),
        "mean_no2": F.avg("nitrogen_dioxide"),
        "mean_o3": F.avg("ozone"),
    }
    return (
        with_country(silver)
        .groupBy("partition_date", "country_code", "source")
        .agg(
            *[round_even(value, 2).alias(name) for name, value in figures.items()],
            F.countDistinct("station_id").alias("station_count"),
            *[
                round_even(F.avg(flag) * 100, 1).alias(f"{flag}_pct")
                for flag in S.WHO_FLAGS.values()
            ],
        )
    )


def wildfire_risk_index(silver: DataFrame) -> DataFrame:
    """Composite 0-100 score per station-day; a pure projection, no shuffle."""
    ozone = clip(F.coalesce("ozone", F.lit(0.0)) / S.RISK_OZONE_REF, 0.0, 1.0)
    pm25 = clip(F.coalesce("pm2_5", F.lit(0.0)) / S.RISK_PM25_REF, 0.0, 1.0)
    score = round_even((ozone * S.RISK_OZONE_SHARE + pm25 * S.RISK_PM25_SHARE) * 100, 1)
    keep = ["partition_date", "source", "station_id", "station_name", "country_code", "latitude",
            "longitude", "pm2_5", "ozone"]
    return silver.select(*[c for c in keep if c in silver.columns], score.alias("risk_index")).withColumn(
        "risk_level", risk_level(F.col("risk_index"))
    )


def one_per_day(weather: DataFrame) -> DataFrame:
    """One row per station and date."""
    keys = ["station_id", "partition_date"]
    rest = F.struct(*[c for c in weather.columns if c not in keys])
    return weather.groupBy(*keys).agg(F.min(rest).alias("_rest")).select("*", "_rest.*").drop("_rest").select(*weather.columns)


def repeated_days(weather: DataFrame) -> DataFrame:
    """(station_id, partition_date, rows, distinct_rows) of station-days that came more than once."""
    values = F.struct(*[c for c in weather.columns if c not in ("station_id", "partition_date")])
    days = weather.groupBy("station_id", "partition_date").agg(
        F.count("*").alias("rows"), F.countDistinct(F.xxhash64(values, *[F.col(c).isNull() for c in weather.columns])).alias("distinct_rows"))
    return days.filter("rows > 1")


def flag_heat_events(weather: DataFrame) -> DataFrame:
    """Unusually hot or cold station-days against the station's own previous 30 rows.

    Baselines and streaks share one window. One row per station and date is made sure of first,
    with map-side partials, which bounds a window partition by the calendar however many rows
    the table has; of several rows the smallest in column order stays.
    """
    weather = one_per_day(weather)
    series = Window.partitionBy("station_id").orderBy("partition_date")
    hot_bar = clip("heat_baseline_c", low=S.HEAT_FLOOR_C)
    cold_bar = clip("cold_baseline_c", high=S.COLD_CEILING_C)
    baselines = {
        "heat_baseline_c": ("temp_max_c", S.HEAT_QUANTILE),
        "cold_baseline_c": ("temp_min_c", S.COLD_QUANTILE),
    }
    flagged = with_trailing_quantiles(weather, series, baselines).withColumns(
        {
            "is_hot_day": F.coalesce(F.col("temp_max_c") > hot_bar, F.lit(False)),
            "is_cold_day": F.coalesce(F.col("temp_min_c") < cold_bar, F.lit(False)),
        }
    )
    flagged = with_streak(flagged, "is_hot_day", series, "heat_streak_days")
    return with_streak(flagged, "is_cold_day", series, "cold_streak_days")


def daily_country_weather(weather: DataFrame) -> DataFrame:
    """Worst reading of each country's stations per day, with heat and cold alert tiers."""
    rounded = {
        "temp_max_c": F.max("temp_max_c"),
        "temp_mean_c": F.avg("temp_mean_c"),
        "temp_min_c": F.min("temp_min_c"),
        "apparent_temp_max_c": F.max("apparent_temp_max_c"),
        "precipitation_mm": F.max("precipitation_mm"),
        "wind_gust_max_kmh": F.max("wind_gust_max_kmh"),
        "humidity_pct": F.avg("humidity_pct"),
        "dust": F.max("dust"),
    }
    days = flag_heat_events(weather).groupBy("partition_date", "country_code").agg(
        F.countDistinct("station_id").alias("stations"),
        *[value.alias(f"_{name}") for name, value in rounded.items()],
        F.max("heat_streak_days").alias("heat_streak_days"),
        F.max("cold_streak_days").alias("cold_streak_days"),
        F.sum(F.col("is_hot_day").cast("long")).alias("stations_hot"),
        F.sum(F.col("is_cold_day").cast("long")).alias("stations_cold"),
        worst(F.col("condition"), S.CONDITION_ORDER).alias("condition"),
        worst(F.col("wind_level"), S.WIND_ORDER).alias("wind_level"),
        worst(F.col("dust_level"), S.DUST_ORDER).alias("dust_level"),
    )
    # Tiers look at the unrounded extremes, which may come from another station than the streak.
    hot, cold = F.col("heat_streak_days"), F.col("cold_streak_days")
    heat_alert = (
        F.when((hot >= S.WAVE_DAYS) & (F.col("_temp_max_c") >= S.EXTREME_HEAT_C), "extreme_heatwave")
        .when(hot >= S.WAVE_DAYS, "heatwave")
        .when(hot > 0, "heat_advisory")
        .otherwise("none")
    )
    cold_alert = (
        F.when((cold >= S.WAVE_DAYS) & (F.col("_temp_min_c") <= S.SEVERE_COLD_C), "severe_cold_wave")
        .when(cold >= S.WAVE_DAYS, "cold_wave")
        .when(cold > 0, "cold_advisory")
        .otherwise("none")
    )
    return days.select(
        "partition_date",
        "country_code",
        "stations",
        *[round_even(F.col(f"_{name}"), 1).alias(name) for name in rounded],
        "heat_streak_days",
        "cold_streak_days",
        "stations_hot",
        "stations_cold",
        "condition",
        "wind_level",
        "dust_level",
        heat_alert.alias("heat_alert"),
        cold_alert.alias("cold_alert"),
    )


def with_gold_ts(df: DataFrame, run_ts: str) -> DataFrame:
    return df.withColumn("gold_ts", F.lit(run_ts))
