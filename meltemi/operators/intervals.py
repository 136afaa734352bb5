"""Intervals of time: from values that hold until the next one, merged, cut to those that last.

An interval is [begin, until) in whole seconds; until is null while it is still open. Every operation is
one exchange by the keys; a window holds one row per value of one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def holding(values: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Each row's values with `begin` and `until`: they hold until the key's next row."""
    later = Window.partitionBy(*keys).orderBy(at)
    return values.withColumns({"begin": F.col(at), "until": F.lead(at).over(later)})


def beside_earlier(values: DataFrame, keys: list[str], at: str, value: str, seconds: int) -> DataFrame:
    """(keys, begin, until, now, earlier): a value beside the one that held `seconds` before, piece by piece.

    Both change at their own times, so the pieces end wherever either does; a piece before either is
    known has a null there.
    """
    known = values.select(*keys, F.col(at).alias("at"), F.col(value).alias("now"), F.lit(None).cast(values.schema[value].dataType).alias("earlier"))
    moved = values.select(*keys, (F.col(at) + seconds).alias("at"), F.lit(None).cast(values.schema[value].dataType).alias("now"), F.col(value).alias("earlier"))
    # Two changes at one time are one.
    changes = known.unionByName(moved).groupBy(*keys, "at").agg(F.max("now").alias("now"), F.max("earlier").alias("earlier"))
    so_far = Window.partitionBy(*keys).orderBy("at")
    filled = changes.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in ("now", "earlier")})
    return holding(filled, keys, "at").drop("at")


def merged(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping and touching intervals of a key as one; an open one swallows all that begin later."""
    forever = F.coalesce(F.col("until"), F.lit(2**62))
    before = Window.partitionBy(*keys).orderBy("begin", forever).rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy(*keys).orderBy("begin", forever).rowsBetween(Window.unboundedPreceding, 0)
    apart = F.coalesce(F.col("begin") > F.max(forever).over(before), F.lit(True))
    islands = intervals.withColumn("_apart", apart.cast("int")).withColumn("_island", F.sum("_apart").over(so_far))
    last = F.max(forever)
    return islands.groupBy(*keys, "_island").agg(
        F.min("begin").alias("begin"), F.when(last < 2**62, last).alias("until")).drop("_island")


def until_now(intervals: DataFrame, now: Column) -> DataFrame:
    """What of the intervals lies before now; one that reaches now is open."""
    inside = intervals.filter(F.col("begin") < now)
    return inside.withColumn("until", F.when(F.col("until") <= now, F.col("until")))


def lasting(intervals: DataFrame, seconds: Column, now: Column) -> DataFrame:
    """Intervals of at least `seconds`, with `fired`, the moment they had lasted that long; an open one lasts until now."""
    fired = F.col("begin") + seconds
    return intervals.withColumn("fired", fired).filter(F.col("fired") <= F.coalesce(F.col("until"), now))
