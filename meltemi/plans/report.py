"""The frames behind the daily report, all from Gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meltemi import settings as S
from meltemi.functions.numeric import round_even
from meltemi.plans.season import Focus, focus_of


# --- coverage and readiness -----------------------------------------------------------
def coverage_by_date(summary: DataFrame) -> DataFrame:
    """Station-days, countries and source mix per date; null keys form no group."""
    return summary.filter(F.col("partition_date").isNotNull()).groupBy("partition_date").agg(
        F.sum("station_count").alias("station_days"),
        F.countDistinct("country_code").alias("countries"),
        F.countDistinct("source").alias("source_count"),
        F.array_join(F.array_sort(F.collect_set("source")), ", ").alias("sources"),
    )


def mark_readiness(
    coverage: DataFrame, lookback: int = S.COVERAGE_LOOKBACK,
    low: float = S.COVERAGE_MIN_RATIO, high: float = S.COVERAGE_MAX_RATIO,
) -> DataFrame:
    """Dates whose coverage compares with the median of the dates before them.

    The window has no partition key, but its input is one row per calendar date, so one task
    sorts some thousands of rows at most; the raw rows were aggregated before it.
    """
    prior = Window.orderBy("partition_date").rowsBetween(-lookback, -1)
    positive = F.when(F.col("station_days") > 0, F.col("station_days"))
    seen = F.count(positive).over(prior)
    median = F.when(seen >= min(3, lookback), F.percentile(positive, F.lit(0.5)).over(prior))
    ratio = F.col("station_days") / F.col("_median")
    return (
        coverage.withColumn("_median", median)
        .withColumn("_ratio", ratio)
        .select(
            *coverage.columns,
            round_even("_median", 2).alias("coverage_baseline_station_days"),
            round_even("_ratio", 3).alias("coverage_ratio"),
            F.coalesce(F.col("_ratio").between(low, high), F.lit(True)).alias("is_reporting_ready"),
        )
    )


def reporting_dates(summary: DataFrame) -> DataFrame:
    return mark_readiness(coverage_by_date(summary)).filter("is_reporting_ready").select("partition_date")


def latest_reporting_dates(summary: DataFrame, n: int = S.DISPLAY_DATES) -> DataFrame:
    """The latest n ready dates, ascending."""
    if n < 1:
        raise ValueError("n must be at least 1")
    newest = reporting_dates(summary).orderBy(F.col("partition_date").desc()).limit(n)
    return newest.orderBy("partition_date")


def on_dates(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows on the given dates. The right side has one row per calendar date, so it is safe to
    broadcast, and the scan of a table partitioned by date is pruned by it."""
    return df.join(F.broadcast(dates.select("partition_date")), "partition_date", "left_semi")


def readiness_diagnostics(summary: DataFrame, anomalies: DataFrame) -> DataFrame:
    coverage = mark_readiness(coverage_by_date(summary))
    rates = anomaly_daily_rates(anomalies)
    return coverage.join(rates, "partition_date", "left").fillna(
        0, subset=["anomaly_flags", "rows", "anomaly_rate_pct"]
    )


def write_diagnostics(diagnostics: DataFrame, path: str) -> None:
    """One CSV: the frame has a row per date."""
    diagnostics.orderBy("partition_date").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


# --- anomalies ------------------------------------------------------------------------
def model_sources(df: DataFrame) -> DataFrame:
    return df.filter(F.col("source").isin(*S.CONCENTRATION_SOURCES)) if "source" in df.columns else df


def anomaly_daily_rates(anomalies: DataFrame) -> DataFrame:
    rows = model_sources(anomalies).filter(F.col("partition_date").isNotNull())
    return rows.groupBy("partition_date").agg(
        F.sum("is_anomaly").cast("long").alias("anomaly_flags"),
        F.count("is_anomaly").alias("rows"),
        round_even(F.sum("is_anomaly") / F.nullif(F.count("is_anomaly"), F.lit(0)) * 100, 2).alias(
            "anomaly_rate_pct"
        ),
    )


def anomaly_by_country(anomalies: DataFrame) -> DataFrame:
    return anomalies.filter(F.col("country_code").isNotNull()).groupBy("country_code").agg(
        F.sum("is_anomaly").cast("long").alias("anomalies"),
        F.count("is_anomaly").alias("total"),
        round_even(F.sum("is_anomaly") / F.count("is_anomaly") * 100, 1).alias("rate"),
    )


def top_anomalies(anomalies: DataFrame, k: int = 10) -> DataFrame:
    """The k most anomalous flagged rows: a take-ordered, never a full sort."""
    return anomalies.filter("is_anomaly = 1").orderBy("anomaly_score", "partition_date", "station_id").limit(k)


def on_newest(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows of the newest of the given dates; none if the table has no such rows."""
    return df.filter(F.col("partition_date") == dates.agg(F.max("partition_date")).scalar())


def most_anomalous(anomalies: DataFrame, dates: DataFrame, k: int = 5) -> DataFrame:
    """The k most anomalous rows of the newest date to show, flagged or not."""
    return on_newest(anomalies, dates).orderBy("anomaly_score", "station_id").limit(k)


def histogram(df: DataFrame, keys: list[str], value: str, bins: Column) -> DataFrame:
    """Equal-width counts per group between its own minimum and maximum.

    Two passes of partial aggregates. The keys have a handful of values, so all bounds fit one
    scalar and the rows are binned where they lie, with no join on a key that is always hot.
    A group with a single value is one unit wide, and the maximum falls in the last bin.
    """
    valued = df.filter(F.col(value).isNotNull())
    low, high, key = F.min(value), F.max(value), F.concat_ws("/", *keys)
    flat = low == high
    bounds = valued.groupBy(*keys).agg(
        F.when(flat, low - 0.5).otherwise(low).alias("low"),
        F.when(flat, high + 0.5).otherwise(high).alias("high"),
        F.count("*").alias("n"),
    )
    per_group = F.struct("low", "high", bins.cast("long").alias("bins"))
    known = bounds.agg(F.map_from_entries(F.collect_list(F.struct(key, per_group)))).scalar()
    place = F.floor((F.col(value) - F.col("_b.low")) / (F.col("_b.high") - F.col("_b.low")) * F.col("_b.bins"))
    return (
        valued.withColumn("_b", known[key])
        .select(*keys, F.col("_b.bins").alias("bins"), F.least(place, F.col("_b.bins") - 1).cast("long").alias("bin"))
        .groupBy(*keys, "bins", "bin")
        .agg(F.count("*").alias("rows"))
    )


def score_histogram(anomalies: DataFrame, dates: DataFrame) -> DataFrame:
    """Scores on the dates to show: of normal rows in 30 bins, of flagged rows in 15."""
    bins = F.when(F.col("is_anomaly") == 1, 15).otherwise(30)
    return histogram(on_dates(anomalies, dates), ["is_anomaly"], "anomaly_score", bins)


def day_value_histogram(anomalies: DataFrame, dates: DataFrame) -> DataFrame:
    """Each pollutant's readings of the newest date to show, in 5 to 20 bins by how many there are."""
    pairs = F.array(*[F.struct(F.lit(f).alias("pollutant"), F.col(f).alias("value")) for f in S.ANOMALY_FEATURES])
    bins = F.least(F.greatest(F.floor(F.col("n") / 2), F.lit(5)), F.lit(20))
    return histogram(on_newest(anomalies, dates).select(F.inline(pairs)), ["pollutant"], "value", bins)


# --- pollutants, risk and sources -----------------------------------------------------
def countries_in(df: DataFrame) -> tuple[str, ...]:
    """Country codes a frame holds, sorted; a report has a few dozen at most."""
    found = df.select("country_code").filter("country_code is not null").distinct().collect()
    return tuple(sorted(row.country_code for row in found))


def _pivot(df: DataFrame, row: str, column: str, values: tuple[str, ...], aggregate) -> DataFrame:
    """Named pivot values: no job to look for them, and the same columns on every run."""
    return df.filter(F.col(row).isNotNull()).groupBy(row).pivot(column, list(values)).agg(aggregate)


def coverage_pivot(summary: DataFrame, dates: DataFrame) -> DataFrame:
    """Station-days per date and country on the display dates; none is zero."""
    shown = on_dates(summary, dates)
    countries = countries_in(shown)
    pivoted = _pivot(shown, "partition_date", "country_code", countries, F.sum("station_count"))
    return pivoted.fillna(0, subset=list(countries))


def pollutants_by_country(summary: DataFrame) -> DataFrame:
    """Mean of the daily PM2.5 and ozone means, per country and source side by side."""

    def mean_of(column: str, source: str) -> Column:
        return round_even(F.avg(F.when(F.col("source") == source, F.col(column))), 2)

    return summary.filter(F.col("country_code").isNotNull()).groupBy("country_code").agg(
        *[mean_of("mean_pm2_5", s).alias(f"pm2_5_{s}") for s in S.AIR_SOURCES],
        *[mean_of("mean_o3", s).alias(f"o3_{s}") for s in S.AIR_SOURCES],
    )


def who_exceed_by_country(summary: DataFrame) -> DataFrame:
    names = [f"{flag}_pct" for flag in S.WHO_FLAGS.values()]
    means = summary.filter(F.col("country_code").isNotNull()).groupBy("country_code").agg(
        *[round_even(F.avg(n), 1).alias(n) for n in names]
    )
    return means.orderBy("who_pm25_exceed_pct", "country_code")


def risk_distribution(risk: DataFrame) -> DataFrame:
    """Station-days per risk level and their share of the country's total."""
    counts = _pivot(risk, "country_code", "risk_level", S.RISK_LEVELS, F.count(F.lit(1))).fillna(
        0, subset=list(S.RISK_LEVELS)
    )
    total = sum((F.col(level) for level in S.RISK_LEVELS), F.lit(0))
    return counts.select(
        "country_code",
        *S.RISK_LEVELS,
        *[round_even(F.col(level) / total * 100, 4).alias(f"{level}_pct") for level in S.RISK_LEVELS],
    )


def top_risk(risk: DataFrame, k: int = 10) -> DataFrame:
    return risk.orderBy(F.col("risk_index").desc(), "partition_date", "station_id").limit(k)


def top_exceedance(summary: DataFrame, k: int = 5) -> DataFrame:
    means = who_exceed_by_country(summary).select("country_code", "who_pm25_exceed_pct")
    return means.orderBy(F.col("who_pm25_exceed_pct").desc_nulls_last(), "country_code").limit(k)


def source_share(summary: DataFrame) -> DataFrame:
    """Station-days per country and source on ready dates, and their share in percent."""
    counts = _pivot(
        on_dates(summary, reporting_dates(summary)), "country_code", "source", S.AIR_SOURCES,
        F.sum("station_count"),
    ).fillna(0, subset=list(S.AIR_SOURCES))
    total = sum((F.col(s) for s in S.AIR_SOURCES), F.lit(0))
    return counts.select(
        "country_code",
        *S.AIR_SOURCES,
        *[round_even(F.col(s) / F.nullif(total, F.lit(0)) * 100, 4).alias(f"{s}_pct") for s in S.AIR_SOURCES],
    )


# --- weather --------------------------------------------------------------------------
def latest_rows(df: DataFrame) -> DataFrame:
    """Rows of the newest partition only; the maximum is a scalar subquery."""
    return df.filter(F.col("partition_date") == df.agg(F.max("partition_date")).scalar())


def latest_conditions(weather: DataFrame, focus: Focus) -> DataFrame:
    """Conditions of the latest date in focus order, countries without a value last."""
    c = F.col(focus.column)
    order = c.asc_nulls_last() if focus.lowest_first else c.desc_nulls_last()
    return latest_rows(weather).select(
        "country_code", "temp_max_c", "temp_min_c", "precipitation_mm", "condition", "wind_level",
        "dust_level", "heat_alert", "heat_streak_days", "cold_alert", "cold_streak_days",
    ).orderBy(order, "country_code")


def focus_pivot(weather: DataFrame, dates: DataFrame, focus: Focus) -> DataFrame:
    shown = on_dates(weather, dates)
    return _pivot(
        shown, "partition_date", "country_code", countries_in(shown),
        F.max(F.col(focus.column).try_cast("double")),
    )


# --- run summary ----------------------------------------------------------------------
def attach(df: DataFrame, *figures: DataFrame) -> DataFrame:
    """Add the columns of one-row frames, each as one scalar subquery: no join."""
    kept = df.columns
    rows = {f"_row{i}": part.select(F.struct(*part.columns)).scalar() for i, part in enumerate(figures)}
    return df.withColumns(rows).select(*kept, *[f"{name}.*" for name in rows])


def _leader(value: Column, lowest: bool = False) -> Column:
    """Over one row per country, the one with the highest (or lowest) value; ties go to the first country code.

    A null country leads nothing.
    """
    order = value if lowest else -value
    shown = value.isNotNull() & F.col("country_code").isNotNull()
    return F.min(F.when(shown, F.struct(order.alias("o"), F.col("country_code").alias("c"))))["c"]


def _names(sets: Column) -> Column:
    """Sorted distinct names out of one set per row, comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(sets)))), ", ")


def report_kpis(
    summary: DataFrame, risk: DataFrame, anomalies: DataFrame, weather: DataFrame
) -> DataFrame:
    """One row of run figures, season and focus of the newest weather date among them.

    Each table is read once: one aggregate per country (and, by a second grouping set, per date or
    station), whose few rows are then reduced to the figures.
    """
    summary_by = summary.groupBy("country_code").agg(
        F.min("partition_date").alias("first_date"), F.max("partition_date").alias("last_date"), F.count("*").alias("n"),
        # As many as the calendar has dates, and as there are sources.
        F.collect_set("partition_date").alias("days"), F.collect_set("source").alias("sources"),
        round_even(F.avg("who_pm25_exceed_pct"), 4).alias("exceed"))
    per_station = F.grouping("station_id") == 0
    risk_by = risk.groupingSets([["country_code"], ["station_id"]], "country_code", "station_id").agg(
        per_station.alias("per_station"), F.count("*").alias("n"), round_even(F.avg("risk_index"), 4).alias("mean"))
    of_station = F.col("per_station")
    per_day = F.grouping("partition_date") == 0
    weather_by = weather.groupingSets([["country_code"], ["partition_date"]], "country_code", "partition_date").agg(
        per_day.alias("per_day"), F.count("*").alias("n"), F.max("temp_max_c").alias("hottest"), F.min("temp_min_c").alias("coldest"),
        F.count(F.when(F.col("heat_alert").isin(*S.HEATWAVE), 1)).alias("heatwaves"),
        F.count(F.when(F.col("cold_alert").isin(*S.COLD_WAVE), 1)).alias("cold_waves"),
        F.count(F.when(F.col("heat_alert") != "none", 1)).alias("hot"), F.count(F.when(F.col("cold_alert") != "none", 1)).alias("cold"))
    of_day = F.col("per_day")

    def total(column: str, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(column))), F.lit(0))

    def of_leader(column: str, lowest: bool = False) -> Column:
        return _leader(F.when(~of_day, F.col(column)), lowest)

    day = F.when(of_day & F.col("partition_date").isNotNull(), F.col("partition_date"))
    newest = F.max_by(F.struct("hot", "cold", "heatwaves", "cold_waves"), day)
    last = F.struct(F.max(day).alias("day"), newest.alias("of"))
    parts = [
        summary_by.agg(
            F.min("first_date").alias("first_date"),
            F.max("last_date").alias("last_date"),
            F.size(F.array_distinct(F.flatten(F.collect_list("days")))).cast("long").alias("dates"),
            F.count("country_code").alias("countries"),
            F.array_join(F.array_sort(F.collect_set("country_code")), ", ").alias("country_list"),
            _names(F.col("sources")).alias("source_list"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("summary_rows"),
            _leader(F.col("exceed")).alias("highest_exceedance_country"),
        ),
        risk_by.agg(
            total("n", ~of_station).alias("risk_rows"),
            F.count(F.when(of_station, F.col("station_id"))).alias("stations"),
            _leader(F.when(~of_station, F.col("mean"))).alias("highest_risk_country"),
        ),
        anomalies.agg(
            F.count("*").alias("anomaly_rows"),
            F.sum("is_anomaly").cast("long").alias("anomalies"),
            round_even(F.avg("is_anomaly") * 100, 1).alias("anomaly_rate_pct"),
        ),
        weather_by.agg(
            total("n", ~of_day).alias("weather_rows"),
            total("heatwaves", ~of_day).alias("heatwave_country_days"),
            total("cold_waves", ~of_day).alias("cold_wave_country_days"),
            of_leader("hottest").alias("hottest_country"),
            of_leader("coldest", lowest=True).alias("coldest_country"),
            last.alias("last"),
        ).select(
            "*", F.coalesce("last.of.hot", F.lit(0)).alias("under_heat_alert"), F.coalesce("last.of.cold", F.lit(0)).alias("under_cold_alert"),
            *focus_of(F.col("last.day"), F.col("last.of.heatwaves") > 0, F.col("last.of.cold_waves") > 0),
        ).drop("last"),
    ]
    return attach(parts[0], *parts[1:])
