"""Exact interpolated quantiles of unbounded groups.

The built-in exact percentile keeps every distinct value of a group in one task's memory.
Here values are counted first, in parallel, and only the values inside the histogram cell
that holds a wanted rank are ever ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELLS = 4096


def group_quantiles(
    df: DataFrame, keys: list[str], value: str, q: float, name: str,
    low: float, high: float, cells: int = CELLS, few_groups: bool = False,
) -> DataFrame:
    """Quantile q of a column per group, null values left out; linear interpolation.

    Groups may have any size. The one or two cells wanted of each are broadcast where the caller knows
    that there are few groups (few_groups: one for each of a fixed list of columns, or one in all);
    else Spark decides by their size.

    low and high say where most values lie. They only shape the cells: values beyond them
    fall in the first or last cell and the result stays exact.

    1. count rows per (group, value): partial counts absorb copies before the shuffle;
    2. add the counts up per cell, at most `cells` rows per group, and find the one or two
       cells that hold the two neighbouring ranks;
    3. order only the distinct values inside those cells.
    """
    ks = [f"_k{i}" for i in range(len(keys))] or ["_k0"]
    key_columns = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)] or [F.lit(0).alias("_k0")]
    place = F.floor((F.col("_v") - low) / (high - low) * cells)
    counts = (
        df.filter(F.col(value).isNotNull())
        .select(*key_columns, F.col(value).alias("_v"))
        .groupBy(*ks, "_v")
        .agg(F.count("*").alias("_n"))
        .withColumn("_cell", F.greatest(F.least(place, F.lit(cells - 1)), F.lit(0)).cast("int"))
    )

    group = Window.partitionBy(*ks)
    before = group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.lit(q) * (F.sum("_in_cell").over(group) - 1)
    by_cell = counts.groupBy(*ks, "_cell").agg(F.sum("_n").alias("_in_cell")).select(
        *ks, "_cell", "_in_cell",
        F.coalesce(F.sum("_in_cell").over(before), F.lit(0)).alias("_before"),
        F.floor(rank).alias("_low_rank"),
        F.ceil(rank).alias("_high_rank"),
        (rank - F.floor(rank)).alias("_fraction"),
    )
    last = F.col("_before") + F.col("_in_cell") - 1
    wanted = by_cell.filter(
        F.col("_low_rank").between(F.col("_before"), last)
        | F.col("_high_rank").between(F.col("_before"), last)
    ).drop("_in_cell")

    inside = _join_null_safe(counts, F.broadcast(wanted) if few_groups else wanted, [*ks, "_cell"])
    upto = Window.partitionBy(*ks, "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn("_stop", F.col("_before") + F.sum("_n").over(upto)).withColumn(
        "_start", F.col("_stop") - F.col("_n")
    )

    def value_at(rank_column: str):
        held = F.col(rank_column).between(F.col("_start"), F.col("_stop") - 1)
        return F.max(F.when(held, F.col("_v")))

    below, above = value_at("_low_rank"), value_at("_high_rank")
    out = ranked.groupBy(*ks).agg((below + (above - below) * F.max("_fraction")).alias(name))
    return out.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], name)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys where null equals null; the left side's keys are kept."""
    match = [F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in keys]
    renamed = right.withColumnsRenamed({k: f"_r{k}" for k in keys})
    return left.join(renamed, match).drop(*[f"_r{k}" for k in keys])
