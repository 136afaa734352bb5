"""Hourly readings to daily means, however late a reading comes.

A mean cannot be corrected by a late reading, its sum and count can. Each micro-batch is reduced to sums
and counts per station-day and stored under its batch number, so a batch that is repeated replaces what
it stored before and adds nothing. The means of the dates a batch touched are then built from all that
is stored for those dates. The stream keeps no state, so nothing is ever too late.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meltemi import settings as S
from meltemi.functions.numeric import round_raw
from meltemi.operators import sinks
from meltemi.sources import snapshots, tables

KEYS = ["station_id", "date"]
BY = ("date", "batch")
#: Batches stored apart for a date before the settled ones are added up into one.
FOLD = 8


def partials(hours: DataFrame) -> DataFrame:
    """Sum and count of every pollutant per station and day; they add up over any split of the readings."""
    days = hours.withColumn("date", F.date_format("ts", "yyyy-MM-dd"))
    return days.groupBy(*KEYS).agg(*[
        e for name in S.POLLUTANTS for e in (F.sum(name).alias(f"{name}_sum"), F.count(name).alias(f"{name}_n"))])


def added(parts: DataFrame) -> DataFrame:
    """One row of sums and counts per station-day."""
    values = [c for c in parts.columns if c.endswith(("_sum", "_n"))]
    return parts.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in values])


def means(parts: DataFrame) -> DataFrame:
    return added(parts).select(
        *KEYS, *[round_raw(F.try_divide(f"{name}_sum", f"{name}_n"), 4).alias(name) for name in S.POLLUTANTS])


def partials_path(path: str) -> str:
    return f"{path.rstrip('/')}_partials"


def _by_day(partitions: list[str]) -> dict[str, list[str]]:
    held = defaultdict(list)
    for p in partitions:
        held[p.split("/")[0]].append(p)
    return held


def _batch(partition: str) -> int:
    return int(partition.rsplit("=", 1)[1])


def fold(spark: SparkSession, store: str, before: int, most: int = FOLD) -> int:
    """Add up the batches before `before` of every date that has more than `most` of them.

    The last batch stays apart, as it alone can be repeated. Sums and the removal of what they were
    made of become visible in one step. Returns how many folders were replaced.
    """
    held = _by_day(sinks.list_partitions(spark, store, BY))
    old = [sorted((p for p in own if _batch(p) < before), key=_batch) for own in held.values()]
    old = [own for own in old if len(own) > most]
    if not old:
        return 0
    # A date's sums go under the last of its batches; one row per date.
    last = spark.createDataFrame([(sinks.folder_day(own[-1]), _batch(own[-1])) for own in old], "date string, batch int")
    merged = added(tables.read_days(spark, store, [p for own in old for p in own])).join(F.broadcast(last), "date")
    return len(sinks.exchange(merged, store, [p for own in old for p in own], BY).removed)


def write_daily_means(hours: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what has landed and stop. A checkpoint belongs to its table: a new one needs a new table."""
    store = partials_path(path)

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        written = sinks.replace_partitions(partials(batch).withColumn("batch", F.lit(number)), store, BY)
        if not written.partitions:
            return
        fold(spark, store, number)
        held = _by_day(sinks.list_partitions(spark, store, BY))
        touched = {p.split("/")[0] for p in written.partitions}
        rows = tables.read_days(spark, store, [p for day in touched for p in held[day]])
        sinks.replace_partitions(means(rows), path, ("date",))
        sinks.clean_up(spark, store)
        sinks.clean_up(spark, path)

    return (
        hours.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def versions_of(spark: SparkSession, path: str) -> DataFrame:
    """What each batch changed in the table of means."""
    return snapshots.history(spark, path)
