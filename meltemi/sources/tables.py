"""Partitioned table reads. Every filter here is on a partition column, so Spark prunes."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meltemi import settings as S
from meltemi.sources import snapshots


def is_missing(error: AnalysisException) -> bool:
    """True for a table never written, as opposed to one that cannot be read."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_table(
    spark: SparkSession, path: str, where: Column | None = None, ddl: str | None = None,
    merge: bool = False, version: int | None = None,
) -> DataFrame:
    """Scan of a partitioned dataset, columns matched by name; partition values stay strings.

    Of a table with versions the newest is read, or the one asked for.

    With a declared schema no footer is opened to plan the scan, and a column an older file
    lacks reads as null. merge finds the union of all files' columns instead, at the price of
    opening every footer.
    """
    found = snapshots.version(spark, path, version)
    if found is not None:
        df = snapshots.read_folders(spark, path, found, None, ddl, merge)
    else:
        reader = spark.read.option("mergeSchema", str(merge).lower())
        df = (reader.schema(ddl) if ddl else reader).parquet(path)
    return df if where is None else df.filter(where)


def read_or_empty(spark: SparkSession, path: str, ddl: str, where: Column | None = None) -> DataFrame:
    """A missing table reads as an empty frame; any other error still raises."""
    try:
        return read_table(spark, path, where, ddl)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return spark.createDataFrame([], ddl)


def read_days(
    spark: SparkSession, path: str, partitions: list[str], ddl: str | None = None
) -> DataFrame:
    """Scan of named partition folders only.

    Planning lists the files of these folders and of no others, so the cost of a window read
    stays flat while the history behind it grows.
    """
    found = snapshots.version(spark, path)
    if found is not None:
        return snapshots.read_folders(spark, path, found, partitions, ddl)
    folders = [f"{path.rstrip('/')}/{p}" for p in partitions]
    reader = spark.read.option("basePath", path)
    return (reader.schema(ddl) if ddl else reader).parquet(*folders)


def read_non_empty(spark: SparkSession, path: str) -> DataFrame:
    """Gold read for publishing: an empty table is refused."""
    df = read_table(spark, path)
    if df.isEmpty():
        raise RuntimeError(f"{path} is empty; refusing to publish from it")
    return df


_SPAN = re.compile(rf"\s*(?:(?P<whole>{'|'.join(S.FULL_REBUILD_WORDS)})|(?P<days>[-+]?\d+))\s*", re.IGNORECASE)


def configured_days(raw: str | None, default: int) -> int | None:
    """Days a setting asks for, one at least; None for the whole table, the default for anything else."""
    found = _SPAN.fullmatch(raw or "")
    if found is None:
        return default
    return max(int(found["days"]), 1) if found["days"] else None


def cutoff(as_of: str | date, days: int | None) -> str | None:
    """First partition date inside a window that ends on as_of; None when unbounded."""
    if days is None:
        return None
    end = as_of if isinstance(as_of, date) else date.fromisoformat(as_of)
    return (end - timedelta(days=days)).isoformat()


def in_window(df: DataFrame, as_of: str | date, days: int | None = S.WINDOW_DAYS) -> DataFrame:
    """Rolling-window read: partitions on or after as_of minus days."""
    first = cutoff(as_of, days)
    return df if first is None else df.filter(F.col("partition_date") >= first)


def check_lead_in(window_days: int | None, refresh_days: int | None) -> None:
    """The oldest refreshed day needs a whole baseline behind it inside the read window."""
    if window_days is None:
        return
    if refresh_days is None or window_days < refresh_days + S.BASELINE_ROWS:
        raise ValueError("the read window must cover the refresh window plus the baseline")


def recent_or_named(
    df: DataFrame, as_of: str | date, lookback: int = 1, dates: list[str] | None = None
) -> DataFrame:
    """Named partitions when given, else those within the lookback."""
    if dates:
        return df.filter(F.col("partition_date").isin(dates))
    return in_window(df, as_of, lookback)


def partition_dates(df: DataFrame) -> DataFrame:
    """Distinct partition dates of a frame, combined map-side."""
    return df.select("partition_date").distinct()


def dates_in_paths(paths: DataFrame, column: str = "path") -> DataFrame:
    """Distinct partition dates named in file paths; a path without one is ignored."""
    found = F.regexp_extract(F.translate(F.col(column), "\\", "/"), r"partition_date=([^/]+)", 1)
    return paths.select(found.alias("partition_date")).filter("partition_date <> ''").distinct()
