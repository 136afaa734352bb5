"""Figures of the daily brief: facts only, no prose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meltemi import settings as S
from meltemi.functions.dates import season_of
from meltemi.functions.numeric import round_even
from meltemi.operators.anomaly import VALUE_SPAN
from meltemi.operators.quantiles import group_quantiles
from meltemi.plans.report import attach, latest_rows
from meltemi.plans.season import focus_for, rank_countries

# --- fixed values: weather fields of a fact record, in reading order ------------------
WEATHER_FIELDS = (
    "temp_max_c", "temp_min_c", "temp_mean_c", "apparent_temp_max_c", "condition", "wind_level",
    "wind_gust_max_kmh", "precipitation_mm", "humidity_pct", "dust", "dust_level", "heat_alert",
    "heat_streak_days", "cold_alert", "cold_streak_days",
)
TEXT_FIELDS = ("condition", "wind_level", "dust_level", "heat_alert", "cold_alert")


def weather_facts(weather: DataFrame) -> DataFrame:
    """Fifteen weather fields per country of one day, numbers to one decimal."""
    return weather.select(
        "country_code",
        *[F.col(f) if f in TEXT_FIELDS else round_even(F.col(f), 1).alias(f) for f in WEATHER_FIELDS],
    )


def country_facts(summary_day: DataFrame, weather_day: DataFrame) -> DataFrame:
    """Air figures per country of one day, joined with that day's weather."""
    air = summary_day.filter(F.col("country_code").isNotNull()).groupBy("country_code").agg(
        F.sum("station_count").alias("stations"),
        round_even(F.avg("mean_pm2_5"), 1).alias("mean_pm2_5"),
        round_even(F.max("max_pm2_5"), 1).alias("max_pm2_5"),
        round_even(F.avg("mean_pm10"), 1).alias("mean_pm10"),
        round_even(F.avg("mean_no2"), 1).alias("mean_no2"),
        round_even(F.avg("mean_o3"), 1).alias("mean_o3"),
        round_even(F.avg("who_pm25_exceed_pct"), 3).alias("who_pm25_exceed_pct"),
    )
    return air.join(weather_facts(weather_day), "country_code", "left")


def latest_country_facts(summary: DataFrame, weather: DataFrame) -> DataFrame:
    newest = summary.agg(F.max("partition_date")).scalar()
    return country_facts(latest_rows(summary), weather.filter(F.col("partition_date") == newest))


def facts_json(facts: DataFrame) -> DataFrame:
    """One JSON object per country; to_json leaves out missing fields."""
    return facts.select("country_code", F.to_json(F.struct(*facts.columns)).alias("facts"))


def weather_profile(history: DataFrame, day: str, rows: int = S.PROFILE_ROWS) -> DataFrame:
    """Recent swings of every country up to a day, over its last rows.

    The cut to the last rows happens before the shuffle (a top-k per country), so what each
    group collects is at most `rows` long. The day-to-day change needs the row before the
    one it belongs to, and the first row of the cut has none.
    """
    by_country = Window.partitionBy("country_code")
    newest = by_country.orderBy(F.col("partition_date").desc())
    recent = (
        history.filter((F.col("partition_date") <= day) & F.col("country_code").isNotNull())
        .withColumn("_recency", F.row_number().over(newest))
        .filter(F.col("_recency") <= rows)
    )
    step = F.col("temp_max_c") - F.lag("temp_max_c").over(by_country.orderBy("partition_date"))
    # Largest absolute change wins, the earliest date on ties; a struct maximum says both.
    recent = recent.withColumn("_step", step).withColumn(
        "_sharpest",
        F.when(
            step.isNotNull(),
            F.struct(F.abs(step).alias("size"), F.col("_recency"), step.alias("step"), F.col("partition_date")),
        ),
    )

    def last(c: str) -> Column:
        return F.max(F.when(F.col("_recency") == 1, F.col(c)))

    heat = F.max(F.coalesce(F.col("heat_alert").isin(*S.HEAT_ALERTS[1:]), F.lit(False)))
    cold = F.max(F.coalesce(F.col("cold_alert").isin(*S.COLD_ALERTS[1:]), F.lit(False)))
    day_record = F.struct(
        F.col("partition_date").alias("date"),
        round_even("temp_max_c", 1).alias("high_c"),
        round_even("temp_min_c", 1).alias("low_c"),
        round_even("precipitation_mm", 1).alias("rain_mm"),
        round_even("dust", 1).alias("dust"),
        "heat_alert",
        "cold_alert",
    )
    return recent.groupBy("country_code").agg(
        F.max("partition_date").alias("date"),
        F.count("*").alias("days_of_history"),
        round_even(last("temp_max_c"), 1).alias("high_c"),
        round_even(last("temp_min_c"), 1).alias("low_c"),
        round_even(last("temp_max_c") - last("temp_min_c"), 1).alias("day_night_range_c"),
        last("heat_alert").alias("heat_alert"),
        F.coalesce(last("heat_streak_days"), F.lit(0)).alias("heat_streak_days"),
        last("cold_alert").alias("cold_alert"),
        F.coalesce(last("cold_streak_days"), F.lit(0)).alias("cold_streak_days"),
        last("condition").alias("condition"),
        round_even(F.max("temp_max_c"), 1).alias("window_highest_c"),
        round_even(F.min("temp_min_c"), 1).alias("window_lowest_c"),
        round_even(F.max("temp_max_c") - F.min("temp_max_c"), 1).alias("window_high_spread_c"),
        (heat & cold).alias("swung_between_heat_and_cold"),
        round_even(last("precipitation_mm"), 1).alias("rain_today_mm"),
        round_even(F.coalesce(F.sum("precipitation_mm"), F.lit(0.0)), 1).alias("window_rain_total_mm"),
        round_even(F.max("precipitation_mm"), 1).alias("window_wettest_day_mm"),
        round_even(last("dust"), 1).alias("dust_today"),
        round_even(F.max("dust"), 1).alias("window_dust_peak"),
        round_even(F.max("_sharpest")["step"], 1).alias("biggest_day_to_day_change_c"),
        F.max("_sharpest")["partition_date"].alias("biggest_change_on"),
        F.to_json(F.array_sort(F.collect_list(day_record))).alias("days"),
    )


def top_anomaly_facts(anomalies: DataFrame, weather: DataFrame, newest: str | None) -> DataFrame:
    """The most anomalous reading of a date, with its country's weather, the day's medians
    and its percentile among the day's readings; nothing if the date has no reading.

    The date is the summary's newest, so an anomaly table that lags behind gives no row. The
    reading itself is the smallest of one aggregate; the medians are exact and distributed.
    """
    day = anomalies.filter(F.col("partition_date") == newest)
    features = list(S.ANOMALY_FEATURES)
    order, shown = ("anomaly_score", "station_id", "source"), ("partition_date", "station_name", "country_code", "is_anomaly")
    # The smallest struct is the first row in this order; every row of the day then meets it as one scalar.
    top = day.agg(F.min(F.struct(*order, *shown, *features))).scalar()
    against = day.withColumn("_top", top).agg(
        F.max("_top").alias("top"),
        F.countDistinct("station_id").alias("stations"),
        *[round_even(F.avg((F.col(f) < F.col(f"_top.{f}")).cast("int")) * 100, 2).alias(f"percentile_{f}") for f in features],
    )
    facts = against.filter("top is not null").select(
        *[f"top.{c}" for c in ("partition_date", "station_id", "station_name", "country_code", "source", "anomaly_score", "is_anomaly")],
        *[round_even(f"top.{f}", 1).alias(f) for f in features], "stations", *[f"percentile_{f}" for f in features],
    )
    pairs = F.array(*[F.struct(F.lit(f).alias("pollutant"), F.col(f).alias("value")) for f in features])
    medians = group_quantiles(day.select(F.inline(pairs)), ["pollutant"], "value", 0.5, "median", *VALUE_SPAN, few_groups=True)
    median_row = medians.agg(
        *[round_even(F.max(F.when(F.col("pollutant") == f, F.col("median"))), 1).alias(f"median_{f}") for f in features]
    )
    today = weather_facts(weather.filter(F.col("partition_date") == newest))
    return attach(facts.join(today, "country_code", "left"), median_row)


def spotlight(history: DataFrame, day: str) -> DataFrame:
    """Profile of the country that leads the day's focus, with what it leads in and by how much."""
    focus = focus_for(history, day)
    leader = rank_countries(history, focus, day).limit(1)
    figures = {
        "season": season_of(F.lit(day).cast("date")), "focus": F.lit(focus.name), "measured": F.lit(focus.column),
        "leader": F.lit("lowest" if focus.lowest_first else "highest"), "rank_days": F.lit(focus.rank_days),
        "unit": F.lit(focus.unit), "value": round_even("value", 1),
    }
    return weather_profile(history, day).join(leader, "country_code").withColumns(figures)


def write_brief(facts: DataFrame, path: str) -> None:
    """One JSON object per line and country."""
    facts.write.mode("overwrite").json(path)
