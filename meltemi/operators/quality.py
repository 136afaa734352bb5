"""Quality suites and audits: every suite is one aggregate pass over its table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meltemi import settings as S
from meltemi.functions.numeric import percent_text, to_double

RESULT = "check_name string, layer string, table string, passed boolean, severity string, detail string"

# --- fixed values: suite definitions -------------------------------------------------
# The check names and the wording of the details below are fixed formats as well.
BRONZE_REQUIRED = ("station_id", "latitude", "longitude", "date", "partition_date", "source")
SILVER_REQUIRED = (
    "station_id", "country_code", "latitude", "longitude", "date", "pm2_5", "pm10",
    "nitrogen_dioxide", "ozone", "aqi_category", "who_pm25_exceed", "data_completeness",
    "source", "silver_ts", "partition_date",
)
WEATHER_TEMPERATURES = ("temp_max_c", "temp_min_c", "temp_mean_c")
WEATHER_REQUIRED = ("station_id", "country_code", "date", "partition_date", *WEATHER_TEMPERATURES)
WEATHER_RANGES = {"precipitation_mm": (0, 1000), "wind_gust_max_kmh": (0, 500),
                  "humidity_pct": (0, 100), "dust": (0, 10000)}


@dataclass(frozen=True)
class Check:
    """One check: the aggregates it needs, and its outcome as columns over them."""

    name: str
    measures: dict[str, Column]
    passed: Column
    severity: Column
    detail: Column


def _literal(name: str, passed: bool, severity: str, detail: str) -> Check:
    return Check(name, {}, F.lit(passed), F.lit(severity), F.lit(detail))


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0)).cast("long")


def row_count(min_rows: int = 1) -> Check:
    n = F.col("n_rows")
    detail = F.concat(n.cast("string"), F.lit(f" rows (min {min_rows})"))
    return Check("row_count_non_zero", {}, n >= min_rows, F.lit("fail"), detail)


def required_columns(df: DataFrame, names: Iterable[str]) -> list[Check]:
    """Answered from the schema alone."""
    return [
        _literal(f"column_exists_{c}", c in df.columns, "fail", "present" if c in df.columns else "MISSING")
        for c in names
    ]


def null_rate(df: DataFrame, c: str, warn: float = 0.30, fail: float = 0.70, hard: bool = True) -> Check:
    name = f"null_rate_{c}"
    if c not in df.columns:
        return _literal(name, False, "fail", f"column '{c}' missing")
    nulls = f"nulls_{c}"
    rate = F.col(nulls) / F.col("n_rows")
    text = percent_text(rate)
    policy = "" if hard else "; non-blocking optional source"
    return Check(
        name,
        {nulls: _count_if(F.col(c).isNull())},
        rate < min(warn, fail),
        F.when(rate >= fail, "fail" if hard else "warn").otherwise("warn"),
        F.when(rate >= fail, F.concat(text, F.lit(f" nulls (threshold {fail:.0%}{policy})")))
        .when(rate >= warn, F.concat(text, F.lit(f" nulls (warn threshold {warn:.0%})")))
        .otherwise(F.concat(text, F.lit(" nulls — OK"))),
    )


def value_range(
    df: DataFrame, c: str, low: float | None = None, high: float | None = None, mostly: float = 0.99
) -> Check:
    name = f"range_{c}"
    if c not in df.columns:
        return _literal(name, False, "warn", f"column '{c}' missing")
    value = to_double(c)
    inside = value.isNotNull()
    if low is not None:
        inside = inside & (value >= low)
    if high is not None:
        inside = inside & (value <= high)
    valued, good = F.col(f"valued_{c}"), F.col(f"inside_{c}")
    share = good / F.nullif(valued, F.lit(0))
    return Check(
        name,
        {f"valued_{c}": _count_if(value.isNotNull()), f"inside_{c}": _count_if(inside)},
        F.coalesce(share >= mostly, F.lit(True)),
        F.lit("warn"),
        F.coalesce(
            F.concat(percent_text(share), F.lit(f" in [{low}, {high}] (required {mostly:.0%})")),
            F.lit("no non-null values to check"),
        ),
    )


def valid_values(df: DataFrame, c: str, values: Iterable[str]) -> Check:
    name = f"valid_values_{c}"
    if c not in df.columns:
        return _literal(name, False, "warn", f"column '{c}' missing")
    bad = F.col(f"invalid_{c}")
    return Check(
        name,
        {f"invalid_{c}": _count_if(F.col(c).isNotNull() & ~F.col(c).isin(*values))},
        bad == 0,
        F.lit("warn"),
        F.when(bad == 0, "all valid").otherwise(F.concat(bad.cast("string"), F.lit(" invalid values"))),
    )


def completeness_floor(df: DataFrame, c: str = "data_completeness", floor: float = S.MIN_COMPLETENESS) -> Check:
    if c not in df.columns:
        return _literal("data_completeness_floor", True, "warn", "column absent — skipped")
    below = F.col(f"below_{c}")
    return Check(
        "data_completeness_floor",
        {f"below_{c}": _count_if(F.col(c) < floor)},
        below == 0,
        F.lit("warn"),
        F.concat(below.cast("string"), F.lit(f" rows below {floor:.0%} completeness")),
    )


def run_suite(
    df: DataFrame, layer: str, table: str, checks: list[Check],
    required: bool = True, dates: list[str] | None = None,
) -> DataFrame:
    """All measures in one aggregate, then one row per check.

    A table without rows gives a single data_present result in place of the suite.
    """
    measures: dict[str, Column] = {"n_rows": F.count("*")}
    for check in checks:
        measures |= check.measures

    def row(name: str, passed: Column, severity: Column, detail: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"), F.lit(layer).alias("layer"), F.lit(table).alias("table"),
            passed.alias("passed"), severity.alias("severity"), detail.alias("detail"),
        )

    target = f"target partition(s): {', '.join(dates)}" if dates else "configured lookback window"
    absent = row("data_present", F.lit(False), F.lit("fail" if required else "warn"),
                 F.lit(f"no data found for {target}"))
    results = F.array(*[row(c.name, c.passed, c.severity, c.detail) for c in checks])
    return df.agg(*[m.alias(name) for name, m in measures.items()]).select(
        F.inline(F.when(F.col("n_rows") == 0, F.array(absent)).otherwise(results))
    )


def bronze_suite(df: DataFrame, source: str, dates: list[str] | None = None) -> DataFrame:
    hard = source in S.REQUIRED_AIR_SOURCES
    checks = [row_count(), *required_columns(df, BRONZE_REQUIRED)]
    for c in S.POLLUTANTS:
        checks += [null_rate(df, c, 0.40, 0.80, hard), value_range(df, c, low=0)]
    checks.append(valid_values(df, "source", S.AIR_SOURCES))
    return run_suite(df, "bronze", f"bronze/{source}/air_quality", checks, hard, dates)


def silver_suite(df: DataFrame, dates: list[str] | None = None) -> DataFrame:
    checks = [row_count(), *required_columns(df, SILVER_REQUIRED)]
    for c in S.POLLUTANTS:
        checks += [null_rate(df, c, 0.30, 0.70), value_range(df, c, low=0)]
    checks += [
        valid_values(df, "aqi_category", S.AQI_LABELS),
        valid_values(df, "source", S.AIR_SOURCES),
        completeness_floor(df),
    ]
    return run_suite(df, "silver", "silver/air_quality", checks, True, dates)


def weather_suite(df: DataFrame, layer: str, table: str, dates: list[str] | None = None) -> DataFrame:
    checks = [row_count(), *required_columns(df, WEATHER_REQUIRED)]
    for c in WEATHER_TEMPERATURES:
        checks += [null_rate(df, c, 0.10, 0.30), value_range(df, c, -60, 60)]
    checks += [value_range(df, c, low, high) for c, (low, high) in WEATHER_RANGES.items()]
    if layer == "silver":
        checks.append(valid_values(df, "condition", S.CONDITION_ORDER))
    return run_suite(df, layer, table, checks, True, dates)


def all_suites(
    bronze_air: dict[str, DataFrame], silver_air: DataFrame,
    bronze_weather: DataFrame, silver_weather: DataFrame, dates: list[str] | None = None,
) -> DataFrame:
    parts = [bronze_suite(df, source, dates) for source, df in sorted(bronze_air.items())]
    parts += [
        silver_suite(silver_air, dates),
        weather_suite(bronze_weather, "bronze", f"bronze/{S.WEATHER_SOURCE}/weather", dates),
        weather_suite(silver_weather, "silver", "silver/weather", dates),
    ]
    return reduce(DataFrame.unionByName, parts)


def summarise(results: DataFrame) -> DataFrame:
    """Checks per layer, severity and outcome."""
    return results.groupBy("layer", "severity", "passed").agg(F.count("*").alias("checks"))


def failures(results: DataFrame) -> DataFrame:
    """Failed checks per check name and layer, the run's failure counters."""
    return results.filter(~F.col("passed")).groupBy("check_name", "layer").agg(F.count("*").alias("failures"))


def require_no_hard_failures(results: DataFrame) -> None:
    """Raise with every hard failure; there is a row per check at most."""
    failed = results.filter(~F.col("passed") & (F.col("severity") == "fail")).collect()
    if failed:
        raise RuntimeError("; ".join(f"{r.table} {r.check_name}: {r.detail}" for r in failed))


@dataclass(frozen=True)
class Audit:
    kind: str
    column: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None

    def violation(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "accepted_values":
            return c.isNotNull() & ~c.isin(*self.values)
        outside = F.lit(False)
        if self.low is not None:
            outside = outside | (c < self.low)
        if self.high is not None:
            outside = outside | (c > self.high)
        return F.coalesce(outside, F.lit(False))


def audit(df: DataFrame, table: str, audits: Iterable[Audit]) -> DataFrame:
    """Violations per audit. Row audits share one aggregate; each uniqueness audit counts
    the key combinations that occur more than once, from map-side partial counts."""
    audits = list(audits)
    by_row = [a for a in audits if a.kind != "unique"]
    parts = []
    if by_row:
        sums = [F.coalesce(_count_if(a.violation()), F.lit(0)).alias(f"a{i}") for i, a in enumerate(by_row)]
        rows = [
            F.struct(F.lit(table).alias("table"), F.lit(a.kind).alias("audit"),
                     F.lit(a.column).alias("column"), F.col(f"a{i}").alias("violations"))
            for i, a in enumerate(by_row)
        ]
        parts.append(df.agg(*sums).select(F.inline(F.array(*rows))))
    for a in audits:
        if a.kind == "unique":
            repeated = df.groupBy(*a.column.split(",")).count().filter("count > 1")
            parts.append(
                repeated.agg(F.count("*").alias("violations")).select(
                    F.lit(table).alias("table"), F.lit(a.kind).alias("audit"),
                    F.lit(a.column).alias("column"), "violations",
                )
            )
    return reduce(DataFrame.unionByName, parts)


def require_clean(audited: DataFrame) -> None:
    broken = audited.filter("violations > 0").collect()
    if broken:
        raise RuntimeError("; ".join(f"{r.table}.{r.column} {r.audit}: {r.violations}" for r in broken))
