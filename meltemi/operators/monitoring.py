"""Per-stage run metrics and the alert rules over them."""

from __future__ import annotations

from dataclasses import dataclass

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meltemi.operators import intervals


# --- fixed values: alert limits -------------------------------------------------------
@dataclass(frozen=True)
class Limits:
    stale_seconds: int
    slow_seconds: int | None = None
    alert_on_zero_rows: bool = False
    alert_on_drop: bool = False


STAGES = {
    "bronze_openmeteo": Limits(90000, slow_seconds=1800, alert_on_drop=True),
    "bronze_openaq": Limits(90000, slow_seconds=1800, alert_on_zero_rows=True),
    "bronze_waqi": Limits(90000, slow_seconds=1800),
    "silver": Limits(93600, slow_seconds=3600),
    "gold": Limits(97200),
    "quality": Limits(93600),
}
# Stages whose age is watched; the two optional sources may stay silent.
WATCHED_FOR_AGE = ("bronze_openmeteo", "silver", "gold", "quality")
ROW_DROP_SHARE = 0.5
# Seconds a condition must last before its alert fires.
HOLD_SECONDS = {"run_stale": 300, "row_count_drop": 600, "no_rows": 60, "quality_failed": 60, "run_slow": 300}
SEVERITY = {"quality_failed": "pipeline"}
DAY_SECONDS = 86400


def metrics_row(
    spark: SparkSession, stage: str, run_ts: str, rows: int, seconds: float, failures: int = 0
) -> DataFrame:
    """One run of one stage, ready to append to the run_metrics table."""
    return spark.createDataFrame(
        [(stage, run_ts, rows, float(seconds), failures)],
        "stage string, run_ts string, rows long, duration_seconds double, quality_failures long",
    ).withColumn("run_ts", F.col("run_ts").cast("timestamp"))


def run_alerts(metrics: DataFrame, as_of: str) -> DataFrame:
    """Alerts raised by the latest run of each stage.

    The count to compare with is that of the last run at least one day before; the windows hold
    one row per stage and run.
    """
    at = F.unix_seconds("run_ts")
    day_before = Window.partitionBy("stage").orderBy(at).rangeBetween(Window.unboundedPreceding, -DAY_SECONDS)
    newest = Window.partitionBy("stage").orderBy(F.col("run_ts").desc())
    latest = (
        metrics.withColumns(
            {"previous_rows": F.last("rows").over(day_before), "_recency": F.row_number().over(newest)}
        )
        .filter("_recency = 1")
        .withColumn(
            "age_seconds",
            F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds("run_ts"),
        )
    )
    stage, rows = F.col("stage"), F.col("rows")

    def limit_of(pick) -> Column:
        chain = F.lit(None).cast("long")
        for name, limits in STAGES.items():
            value = pick(limits)
            if value is not None:
                chain = F.when(stage == name, F.lit(value).cast("long")).otherwise(chain)
        return chain

    watched = stage.isin(*WATCHED_FOR_AGE)
    zero = stage.isin(*[s for s, limits in STAGES.items() if limits.alert_on_zero_rows])
    drops = stage.isin(*[s for s, limits in STAGES.items() if limits.alert_on_drop])
    rules = [
        ("run_stale", watched & (F.col("age_seconds") > limit_of(lambda x: x.stale_seconds)),
         F.col("age_seconds").cast("double"), "warning"),
        ("row_count_drop", drops & (rows < F.col("previous_rows") * ROW_DROP_SHARE), rows.cast("double"), "warning"),
        ("no_rows", zero & (rows < 1), rows.cast("double"), "warning"),
        ("quality_failed", F.col("quality_failures") > 0, F.col("quality_failures").cast("double"), "pipeline"),
        ("run_slow", F.col("duration_seconds") > limit_of(lambda x: x.slow_seconds),
         F.col("duration_seconds"), "warning"),
    ]
    raised = [
        F.when(condition, F.struct(F.lit(name).alias("alert"), F.lit(severity).alias("severity"),
                                   value.alias("value")))
        for name, condition, value, severity in rules
    ]
    layer = F.substring_index(stage, "_", 1)
    return latest.select("stage", layer.alias("layer"), F.inline(F.array_compact(F.array(*raised))))


def _of(stages: list[str]) -> Column:
    return F.col("stage").isin(stages)


def _by_stage(limits: dict[str, int]) -> Column:
    pairs = [F.lit(x) for pair in limits.items() for x in pair]
    return F.create_map(*pairs)[F.col("stage")]


def conditions(metrics: DataFrame) -> DataFrame:
    """(alert, stage, begin, until): when each rule's condition held, by the run log.

    A run's figures hold until the stage's next run. The slow rule of the Bronze layer looks at its
    slowest stage, so its intervals are those of any of them, under the layer's name.
    """
    runs = metrics.select("stage", F.unix_seconds("run_ts").alias("at"), "rows", "duration_seconds", "quality_failures")
    # Two runs logged for one second: the worse figures count.
    runs = runs.groupBy("stage", "at").agg(F.min("rows").alias("rows"), *[F.max(c).alias(c) for c in ("duration_seconds", "quality_failures")])
    held = intervals.holding(runs, ["stage"], "at")
    stale = {s: STAGES[s].stale_seconds for s in WATCHED_FOR_AGE}
    slow = {s: x.slow_seconds for s, x in STAGES.items() if x.slow_seconds}
    overdue = held.withColumn("begin", F.col("at") + _by_stage(stale)).filter(
        _of(list(stale)) & (F.col("until").isNull() | (F.col("begin") < F.col("until"))))
    drop = intervals.beside_earlier(
        runs.filter(_of([s for s, x in STAGES.items() if x.alert_on_drop])), ["stage"], "at", "rows", DAY_SECONDS)
    found = {
        "run_stale": overdue,
        "row_count_drop": drop.filter(F.col("now") < F.col("earlier") * ROW_DROP_SHARE),
        "no_rows": held.filter(_of([s for s, x in STAGES.items() if x.alert_on_zero_rows]) & (F.col("rows") < 1)),
        "quality_failed": held.filter("quality_failures > 0"),
        "run_slow": held.filter(_of(list(slow)) & (F.col("duration_seconds") > _by_stage(slow))).withColumn(
            "stage", F.when(F.col("stage").startswith("bronze_"), "bronze").otherwise(F.col("stage"))),
    }
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(alert).alias("alert"), "stage", "begin", "until") for alert, df in found.items()])


def alert_intervals(metrics: DataFrame, as_of: str) -> DataFrame:
    """(alert, severity, stage, begin, fired, resolved): every alert up to as_of whose condition lasted its holding time.

    Intervals that follow each other without a gap are one. An alert still firing at as_of has no
    resolved time; a condition that ended sooner than its holding time, or has not lasted it yet, raised none.
    """
    now = F.unix_seconds(F.lit(as_of).cast("timestamp"))
    hold = F.create_map(*[F.lit(x) for pair in HOLD_SECONDS.items() for x in pair])[F.col("alert")]
    held = intervals.merged(conditions(metrics), ["alert", "stage"])
    fired = intervals.lasting(intervals.until_now(held, now), hold, now)
    severity = F.coalesce(F.create_map(*[F.lit(x) for pair in SEVERITY.items() for x in pair])[F.col("alert")], F.lit("warning"))
    times = [F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd HH:mm:ss").alias(n) for c, n in (
        ("begin", "begin"), ("fired", "fired"), ("until", "resolved"))]
    return fired.select("alert", severity.alias("severity"), "stage", *times)


def quality_alerts(failures: DataFrame) -> DataFrame:
    """One alert per failed check and layer, from quality.failures."""
    return failures.filter("failures > 0").select(
        F.lit("quality_failed").alias("alert"), F.lit("pipeline").alias("severity"), "check_name", "layer",
        F.col("failures").cast("double").alias("value"),
    )


def never_ran(spark: SparkSession, metrics: DataFrame) -> DataFrame:
    """Watched stages without any run: no data alerts as well."""
    wanted = spark.createDataFrame([(s,) for s in WATCHED_FOR_AGE], "stage string")
    return wanted.join(metrics.select("stage").distinct(), "stage", "left_anti")


def partition_metrics(df: DataFrame, stage: str) -> DataFrame:
    """Rows per partition of a stage's table."""
    return df.groupBy("partition_date").agg(F.count("*").alias("rows")).select(
        F.lit(stage).alias("stage"), "partition_date", "rows"
    )
