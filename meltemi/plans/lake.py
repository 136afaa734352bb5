"""The daily jobs: Bronze partitions to Silver, Silver window to Gold, checks, metrics."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meltemi import settings as S
from meltemi.operators import anomaly, bronze, contracts, gold, incremental, marts, monitoring, quality, silver, sinks
from meltemi.operators.incremental import FINGERPRINTS
from meltemi.schemas import BRONZE_AIR, RUN_METRICS, SILVER_AIR, SILVER_WEATHER
from meltemi.session import scratch_path
from meltemi.sources import tables


@dataclass(frozen=True)
class Lake:
    """Where the tables live."""

    root: str

    def bronze(self, source: str) -> str:
        name = "weather" if source == S.WEATHER_SOURCE else "air_quality"
        return f"{self.root}/bronze/{source}/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def mart(self, name: str) -> str:
        return f"{self.root}/marts/{name}"

    @property
    def fingerprints(self) -> str:
        return f"{self.root}/fingerprints"

    @property
    def run_metrics(self) -> str:
        return f"{self.root}/run_metrics"


def pending(spark: SparkSession, bronze: str, silver_path: str, source: str) -> list[str]:
    """Bronze dates Silver lacks for one source, from directory names alone."""
    have = sinks.partition_days(sinks.list_partitions(spark, bronze))
    held = sinks.list_partitions(spark, silver_path, sinks.DAY_SOURCE)
    done = sinks.partition_days([p for p in held if p.endswith(f"/source={source}")])
    return sorted(set(have) - set(done))


def ingest(spark: SparkSession, lake: Lake, source: str, df: DataFrame) -> sinks.Written:
    """Append a Bronze batch; dates the table already holds are skipped."""
    path = lake.bronze(source)
    held = sinks.partition_days(sinks.list_partitions(spark, path))
    rows = df.filter(~F.col("partition_date").isin(held)) if held else df
    return sinks.append(rows, path, sinks.DAY)


def ingest_weather_range(
    spark: SparkSession, lake: Lake, df: DataFrame, expected: DataFrame, start: str, end: str,
    rebuild: bool = False,
) -> sinks.Written | None:
    """Backfill a closed date range: only its missing dates, or all of them on a rebuild.

    Every expected station or none: a range written without one of them would count as done.
    None means there was nothing to write.
    """
    path = lake.bronze(S.WEATHER_SOURCE)
    days = df.filter(F.col("partition_date").between(start, end))
    if not rebuild:
        held = sinks.partition_days(sinks.list_partitions(spark, path))
        days = days.filter(~F.col("partition_date").isin(held)) if held else days
    if days.isEmpty():
        return None
    bronze.require_complete(days, expected)
    if rebuild:
        return sinks.replace_range(days, path, start, end, sinks.DAY)
    return sinks.append(days, path, sinks.DAY)


@dataclass(frozen=True)
class Work:
    """Bronze partitions of a source that Silver has yet to take: their dates, and what to remember of all looked at."""

    days: list[str]
    seen: DataFrame | None


def outdated(spark: SparkSession, lake: Lake, source: str, ddl: str, silver_path: str) -> Work:
    """Partitions Silver lacks, and those whose rows are no longer the ones it was built from.

    Only partitions whose files are not the ones seen last time are read; one that was landed again
    with the same rows, in whatever files and order, is not built again.
    """
    path = lake.bronze(source)
    lacking = set(pending(spark, path, silver_path, source))
    kept = tables.read_or_empty(spark, lake.fingerprints, FINGERPRINTS, F.col("source") == source)
    known = {r.partition_date: r.listing for r in kept.select("partition_date", "listing").collect()}  # one per date
    now = {sinks.folder_day(p): listing for p, listing in sinks.listings(spark, path).items()}
    moved = sorted(d for d, listing in now.items() if d is not None and known.get(d) != listing)
    if not moved:
        return Work(sorted(lacking), None)
    rows = tables.read_days(spark, path, [sinks.folder_name(spark, {"partition_date": d}) for d in moved], ddl).withColumn("source", F.lit(source))
    listed = spark.createDataFrame([(d, now[d]) for d in moved], "partition_date string, listing string")
    seen = incremental.fingerprints(rows).join(F.broadcast(listed), "partition_date").select(
        "n", "fingerprint", "listing", "source", "partition_date")
    # Written once, as it decides what is built and is kept after that.
    seen_path = scratch_path(spark, "fingerprints")
    seen.write.parquet(seen_path)
    seen = spark.read.schema(seen.schema).parquet(seen_path)
    changed = {r.partition_date for r in incremental.changed_partitions(seen, kept).collect()}
    # A partition built before fingerprints were kept counts as built from what is there now.
    changed -= {d for d in changed if d not in known and d not in lacking}
    return Work(sorted(lacking | changed), seen)


def remember(spark: SparkSession, lake: Lake, work: list[Work]) -> None:
    """Keep the fingerprints of what was built; called after the build, so that a run that fails builds again."""
    seen = [w.seen for w in work if w.seen is not None]
    if seen:
        sinks.replace_partitions(reduce(DataFrame.unionByName, seen), lake.fingerprints, ("source", "partition_date"))


def run_silver_air(spark: SparkSession, lake: Lake, grid: DataFrame, run_ts: str) -> int:
    """All new and changed partitions of all sources in one job and one commit."""
    target = lake.silver("air_quality")
    frames, work = {}, []
    for source in S.AIR_SOURCES:
        todo = outdated(spark, lake, source, BRONZE_AIR, target)
        work.append(todo)
        if todo.days:
            folders = [sinks.folder_name(spark, {"partition_date": d}) for d in todo.days]
            frames[source] = tables.read_days(spark, lake.bronze(source), folders, BRONZE_AIR)
    rows = sinks.replace_partitions(silver.union_sources(frames, grid, run_ts), target, sinks.DAY_SOURCE).rows if frames else 0
    remember(spark, lake, work)
    return rows


def run_silver_weather(spark: SparkSession, lake: Lake, run_ts: str, rebuild: bool = False) -> int:
    source, target = S.WEATHER_SOURCE, lake.silver("weather")
    path = lake.bronze(source)
    if rebuild:
        built = silver.build_weather(tables.read_table(spark, path), run_ts)
        return sinks.overwrite(built, target, sinks.DAY_SOURCE).rows
    dates = pending(spark, path, target, source)
    if not dates:
        return 0
    rows = tables.read_days(spark, path, [f"partition_date={d}" for d in dates])
    return sinks.append(silver.build_weather(rows, run_ts), target, sinks.DAY_SOURCE).rows


def read_window(
    spark: SparkSession, path: str, as_of: str, days: int | None, ddl: str,
    by: tuple[str, ...] = sinks.DAY_SOURCE, dates: list[str] | None = None,
) -> DataFrame | None:
    """The named partitions, or those inside the window; None when there are none."""
    first = tables.cutoff(as_of, days)

    def inside(day: str | None) -> bool:
        if dates:
            return day in dates
        return first is None or (day is not None and day >= first)

    held = sinks.list_partitions(spark, path, by)
    wanted = [p for p in held if inside(sinks.folder_day(p))]
    return tables.read_days(spark, path, wanted, ddl) if wanted else None


def run_gold(
    spark: SparkSession, lake: Lake, as_of: str, run_ts: str,
    window_days: int | None = S.WINDOW_DAYS, refresh_days: int | None = S.REFRESH_DAYS,
    with_anomalies: bool = True,
) -> dict[str, sinks.Written]:
    """Refresh the four Gold tables from one pruned window of Silver.

    Missing weather costs its own table only; weather that exists but cannot be read raises.
    """
    air = read_window(spark, lake.silver("air_quality"), as_of, window_days, SILVER_AIR)
    if air is None or air.isEmpty():
        raise RuntimeError("Silver is empty in the window; Gold cannot be produced")
    weather = read_window(spark, lake.silver("weather"), as_of, window_days, SILVER_WEATHER)

    built = {
        "daily_country_summary": gold.daily_country_summary(air),
        "wildfire_risk_index": gold.wildfire_risk_index(air),
    }
    if weather is not None and not weather.isEmpty():
        built["daily_country_weather"] = gold.daily_country_weather(weather)
    if with_anomalies:
        built["anomaly_alerts"] = anomaly.anomaly_alerts(air)
    return {
        name: sinks.refresh(
            gold.with_gold_ts(df, run_ts), lake.gold(name), as_of, refresh_days, window_days
        )
        for name, df in built.items()
    }


def repeated_weather(spark: SparkSession, lake: Lake, as_of: str, window_days: int | None = S.WINDOW_DAYS) -> DataFrame:
    """Station-days of the window that Silver holds more than once; a refresh uses the smallest row of each."""
    rows = read_window(spark, lake.silver("weather"), as_of, window_days, SILVER_WEATHER)
    return gold.repeated_days(spark.createDataFrame([], SILVER_WEATHER) if rows is None else rows)


def run_marts(spark: SparkSession, lake: Lake, run_ts: str) -> dict[str, sinks.Written]:
    """Rebuild the four marts from all of Silver.

    The staging view is audited before anything is written, and each mart after its write, on
    the stored rows; a violation stops the run.
    """
    stg = marts.stg_air_quality(
        tables.read_table(spark, lake.silver("air_quality"), ddl=SILVER_AIR)
    )
    quality.require_clean(quality.audit(stg, "stg_air_quality", marts.AUDITS["stg_air_quality"]))
    done = {}
    for name, build in marts.MARTS.items():
        path = lake.mart(name)
        done[name] = sinks.overwrite(
            marts.with_mart_ts(build(stg), run_ts), path, ("observation_date",)
        )
        stored = tables.read_table(spark, path)
        quality.require_clean(quality.audit(stored, name, marts.AUDITS[name]))
    return done


def run_quality(
    spark: SparkSession, lake: Lake, as_of: str, lookback: int = 1, dates: list[str] | None = None
) -> DataFrame:
    """All suites over recent or named partitions; a missing table counts as no data."""

    def recent(path: str, ddl: str, by: tuple[str, ...]) -> DataFrame:
        rows = read_window(spark, path, as_of, lookback, ddl, by, dates)
        return spark.createDataFrame([], ddl) if rows is None else rows

    return quality.all_suites(
        {s: recent(lake.bronze(s), BRONZE_AIR, sinks.DAY) for s in S.AIR_SOURCES},
        recent(lake.silver("air_quality"), SILVER_AIR, sinks.DAY_SOURCE),
        recent(lake.bronze(S.WEATHER_SOURCE), SILVER_WEATHER, sinks.DAY),
        recent(lake.silver("weather"), SILVER_WEATHER, sinks.DAY_SOURCE),
        dates,
    )


def run_contracts(
    spark: SparkSession, lake: Lake, dates: list[str] | None = None, documents: str | None = None
) -> DataFrame:
    readers = {
        name: (lambda name=name: tables.read_table(spark, lake.gold(name))) for name in contracts.CONTRACTS
    }
    return contracts.verify_gold(spark, readers, dates, documents)


def record(
    spark: SparkSession, lake: Lake, stage: str, run_ts: str, rows: int, started: float, failures: int = 0
) -> None:
    """Append one run to the metrics table."""
    row = monitoring.metrics_row(spark, stage, run_ts, rows, time.monotonic() - started, failures)
    row.write.mode("append").parquet(lake.run_metrics)


def alerts(spark: SparkSession, lake: Lake, as_of: str) -> DataFrame:
    return monitoring.run_alerts(tables.read_or_empty(spark, lake.run_metrics, RUN_METRICS), as_of)


def alert_history(spark: SparkSession, lake: Lake, as_of: str) -> DataFrame:
    """When each alert began, fired and was resolved."""
    return monitoring.alert_intervals(tables.read_or_empty(spark, lake.run_metrics, RUN_METRICS), as_of)


def tidy(spark: SparkSession, lake: Lake, keep: int = 30) -> dict[str, dict[str, int]]:
    """Drop all but the newest versions of every table that has any, and the folders only those used."""
    names = ["daily_country_summary", "wildfire_risk_index", "daily_country_weather", "anomaly_alerts"]
    paths = [
        *(lake.bronze(s) for s in (*S.AIR_SOURCES, S.WEATHER_SOURCE)), *(lake.silver(n) for n in ("air_quality", "weather")),
        *(lake.gold(n) for n in names), *(lake.mart(n) for n in marts.MARTS), lake.fingerprints,
    ]
    return {p: sinks.clean_up(spark, p, keep) for p in paths}
