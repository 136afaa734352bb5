"""Row-window operators over station series.

Windows count rows, not calendar days: a gap neither shortens a baseline nor ends a streak.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from meltemi import settings as S


def with_trailing_quantiles(
    df: DataFrame, window: WindowSpec, wanted: dict[str, tuple[str, float]]
) -> DataFrame:
    """Interpolated quantiles of the previous rows, null until enough of them are non-null.

    wanted maps an output name to (column, q). The frame holds at most BASELINE_ROWS values,
    so each is collected and sorted as a short array: several times cheaper than rebuilding
    an exact percentile per row. low + (high - low) * fraction gives a steady series back
    exactly, so a day level with its baseline is never above it.
    """
    prior = window.rowsBetween(-S.BASELINE_ROWS, -1)
    sorted_values = {
        f"_{name}": F.sort_array(F.collect_list(column).over(prior))
        for name, (column, _) in wanted.items()
    }
    quantiles = {}
    for name, (_, q) in wanted.items():
        values, rank = f"_{name}", f"((size(_{name}) - 1) * {q}D)"
        low = f"element_at({values}, cast(floor({rank}) as int) + 1)"
        high = f"element_at({values}, cast(ceil({rank}) as int) + 1)"
        quantiles[name] = F.expr(
            f"case when size({values}) >= {S.BASELINE_MIN_ROWS} "
            f"then {low} + ({high} - {low}) * ({rank} - floor({rank})) end"
        )
    return df.withColumns(sorted_values).withColumns(quantiles).drop(*sorted_values)


def with_streak(df: DataFrame, flag: str, window, name: str) -> DataFrame:
    """Consecutive true rows ending on each row.

    The running count of rows minus the position of the last false row: both use the same
    window, so no second sort by island is needed.
    """
    running = window.rowsBetween(Window.unboundedPreceding, 0)
    position = F.row_number().over(window)
    last_break = F.max(F.when(~F.coalesce(F.col(flag), F.lit(False)), F.col("_row"))).over(running)
    return (
        df.withColumn("_row", position)
        .withColumn(name, (F.col("_row") - F.coalesce(last_break, F.lit(0))).cast("long"))
        .drop("_row")
    )
