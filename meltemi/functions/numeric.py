"""Coercion, clipping and rounding with missing values kept as null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 18 digits keep a decimal in one long, so rounding never allocates a BigDecimal per row.
# Every rounded quantity is bounded far below the 10 integer digits this leaves.
ROUNDING_TYPE = "decimal(18,8)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    """Number or null: text that is no number and NaN both become null."""
    return F.nanvl(_col(c).try_cast("double"), F.lit(None).cast("double"))


def clip(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Clamp a value; null stays null (bare greatest/least would return the bound)."""
    c = _col(c)
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(c.isNotNull(), out)


def round_even(c: Column | str, digits: int) -> Column:
    """Half-even rounding on a decimal, so the last bit of a double sum cannot flip a tie."""
    return F.bround(_col(c).cast(ROUNDING_TYPE), digits).cast("double")


def round_raw(c: Column | str, digits: int) -> Column:
    """round_even for values nothing has bounded yet: beyond 30 integer digits they pass unrounded."""
    c = _col(c)
    return F.coalesce(F.bround(c.try_cast("decimal(38,8)"), digits).cast("double"), c.cast("double"))


def round_up(c: Column | str, digits: int) -> Column:
    """Half-up rounding on a decimal, the rule of the SQL marts."""
    return F.round(_col(c).cast(ROUNDING_TYPE), digits).cast("double")


def percent_text(rate: Column, digits: int = 1) -> Column:
    """0.1234 -> '12.3%'."""
    scaled = F.bround((rate * 100).cast(ROUNDING_TYPE), digits)
    return F.concat(scaled.cast(f"decimal(18,{digits})").cast("string"), F.lit("%"))
