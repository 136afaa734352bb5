"""Baselines and streaks day by day: state per station instead of a window over its past.

A batch window reads a lead-in before every day it judges. Here each station keeps its last 30 days and
running streaks as state, so a new day costs itself. All days stay in a keyed map beside that, one small
entry per month of the calendar, so that a batch reads and writes state by the month and not by the day: when a
day comes late, or comes again, it is put in its place, and it and every day after it is judged anew and sent out.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from meltemi import settings as S
from meltemi.operators import sinks
from meltemi.session import scratch_path
from meltemi.sources import tables

# The processors travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BASELINE_ROWS, BASELINE_MIN_ROWS = S.BASELINE_ROWS, S.BASELINE_MIN_ROWS
HEAT_QUANTILE, COLD_QUANTILE = S.HEAT_QUANTILE, S.COLD_QUANTILE
HEAT_FLOOR_C, COLD_CEILING_C = S.HEAT_FLOOR_C, S.COLD_CEILING_C
FLAGS = tuple(S.WHO_FLAGS.values())
#: Length of a place up to its month: a mark, year, month.
MONTH = len("\x012024-01")


def quantile(values: list[float | None], q: float, least: int) -> float | None:
    """Interpolated quantile of what is not null; null for fewer than `least`."""
    known = sorted(v for v in values if v is not None)
    if len(known) < least:
        return None
    rank = (len(known) - 1) * q
    low, high = known[int(rank)], known[-int(-rank // 1)]
    return low + (high - low) * (rank - int(rank))


class Series(StatefulProcessor):
    """Judges the days of a key in order. A subclass names its columns, how many days a judgement looks
    back, and the judgement: figures and flags of a day, from its values and those of the days before.

    Of rows that give one day twice in a batch the smallest stays; a day that comes in a later batch
    replaces the one there was.
    """

    keys: tuple[str, ...] = ()
    day: tuple[str, ...] = ()
    values: tuple[str, ...] = ()
    figures: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    streaks: tuple[str, ...] = ()
    back = 0

    def judge(self, before: list[list], values: list) -> tuple[list, list[bool]]:
        raise NotImplementedError

    def init(self, handle) -> None:
        # JSON texts, since Spark converts a state value by value. Of `last`: the newest day, the values of the last
        # `back` days, oldest first, and the streaks up to it. Of a month: values and streaks by day.
        self.last = handle.getValueState("last", "state string")
        self.months = handle.getMapState("months", "month string", "days string")
        self.row = Row(*self.keys, *self.day, *self.values, *self.figures, *self.flags, *self.streaks)

    def place(self, row) -> str:
        """Orders days as Spark orders their columns: nulls first."""
        return "\x1f".join("" if row[c] is None else "\x01" + str(row[c]) for c in self.day)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        fresh: dict[str, list] = {}
        for row in rows:
            values = [None if row[c] is None else float(row[c]) for c in self.values]
            at = self.place(row)
            order = [(v is not None, v) for v in values]
            if at not in fresh or order < [(v is not None, v) for v in fresh[at]]:
                fresh[at] = values
        newest, before, streaks = None, [], [0] * len(self.flags)
        # Months that the state has and that days may be put into. Each call on a state is a message to the JVM.
        months: dict[str, dict] = {}
        last = self.last.get()
        if last is not None:
            newest, before, streaks = json.loads(last[0])
        todo = sorted(fresh.items())
        if newest is not None and todo[0][0] <= newest:
            # A late day: go on from the day before it, through all that follow.
            months = {month: json.loads(days) for (month,), (days,) in self.months.iterator()}
            held = sorted(item for days in months.values() for item in days.items())
            earlier = [v for d, v in held if d < todo[0][0]]
            todo = sorted({**{d: v[0] for d, v in held if d >= todo[0][0]}, **fresh}.items())
            before = [v[0] for v in earlier[-self.back:]] if self.back else []
            streaks = earlier[-1][1] if earlier else [0] * len(self.flags)
        elif newest is not None and todo[0][0][:MONTH] == newest[:MONTH]:
            # Of the months that days later than the newest one are in, the state has at most the first.
            months[newest[:MONTH]] = json.loads(self.months.getValue((newest[:MONTH],))[0])
        changed: dict[str, dict] = {}
        for at, values in todo:
            figures, flags = self.judge(before, values)
            streaks = [n + 1 if f else 0 for n, f in zip(streaks, flags)]
            before = [*before, values][-self.back:] if self.back else []
            month = at[:MONTH]
            if month not in changed:
                changed[month] = months.get(month, {})
            changed[month][at] = values, streaks
            yield self.row(*key, *[p[1:] if p else None for p in at.split("\x1f")], *values, *figures, *flags, *streaks)
        for month, days in changed.items():
            self.months.updateValue((month,), (json.dumps(days),))
        self.last.update((json.dumps((todo[-1][0], before, streaks)),))

    def close(self) -> None:
        pass

    def schema(self) -> str:
        return ", ".join([
            *(f"{c} string" for c in (*self.keys, *self.day)), *(f"{c} double" for c in (*self.values, *self.figures)),
            *(f"{c} boolean" for c in self.flags), *(f"{c} long" for c in self.streaks)])


class HeatEvents(Series):
    """Hot and cold days of a station against its own last 30 rows, and how long they go on."""

    keys, day = ("station_id",), ("partition_date",)
    values = ("temp_max_c", "temp_min_c")
    figures = ("heat_baseline_c", "cold_baseline_c")
    flags = ("is_hot_day", "is_cold_day")
    streaks = ("heat_streak_days", "cold_streak_days")
    back = BASELINE_ROWS

    def judge(self, before, values):
        heat = quantile([v[0] for v in before], HEAT_QUANTILE, BASELINE_MIN_ROWS)
        cold = quantile([v[1] for v in before], COLD_QUANTILE, BASELINE_MIN_ROWS)
        hot = heat is not None and values[0] is not None and values[0] > max(heat, HEAT_FLOOR_C)
        chilly = cold is not None and values[1] is not None and values[1] < min(cold, COLD_CEILING_C)
        return [heat, cold], [hot, chilly]


class Exceedances(Series):
    """Days on which a station's source exceeded a guideline, and how long they go on."""

    keys, day = ("station_id", "source"), ("observation_date", "station_name", "country_code")
    values = FLAGS
    flags, streaks = ("exceeded",), ("current_exceedance_streak_days",)

    def judge(self, before, values):
        return [], [any(v == 1 for v in values)]


def judged(rows: DataFrame, series: Series) -> DataFrame:
    """The stream of judged days; a null key has no series."""
    spark = rows.sparkSession
    if "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", ""):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    wanted = rows.select(
        *[F.col(c).cast("string").alias(c) for c in (*series.keys, *series.day)], *[F.col(c).cast("double").alias(c) for c in series.values])
    wanted = wanted.filter(" and ".join(f"{c} is not null" for c in (*series.keys, series.day[0])))
    return wanted.groupBy(*series.keys).transformWithState(
        statefulProcessor=series, outputStructType=series.schema(), outputMode="Update", timeMode="None")


def write_judged(rows: DataFrame, series: Series, path: str, checkpoint: str) -> StreamingQuery:
    """Process what has landed and stop; judged days replace what the table, partitioned by date, has of them."""
    date = series.day[0]
    keys = [*series.keys, *series.day]

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        staged = scratch_path(spark, "judged")
        batch.write.parquet(staged)
        changed = spark.read.schema(batch.schema).parquet(staged)
        days = {r[date] for r in changed.select(date).distinct().collect()}  # one per calendar date
        held = [p for p in sinks.list_partitions(spark, path, (date,)) if sinks.folder_day(p) in days]
        out = changed
        if held:
            same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
            old = tables.read_days(spark, path, held).select(*batch.columns)
            out = out.unionByName(old.alias("old").join(changed.alias("new"), same, "left_anti"))
        if days:
            sinks.replace_partitions(out, path, (date,))

    return (
        judged(rows, series).writeStream.foreachBatch(merge)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
