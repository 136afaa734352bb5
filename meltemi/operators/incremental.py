"""Which partitions still need work, and how refreshed rows join the kept history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def unprocessed_partitions(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Bronze (source, date) pairs Silver does not hold yet.

    Both sides are reduced to partition pairs first, so the anti join handles at most one
    row per source and day whatever the tables weigh.
    """
    pair = ["source", "partition_date"]
    return bronze.select(*pair).distinct().join(silver.select(*pair).distinct(), pair, "left_anti")


PAIR = ["source", "partition_date"]
FINGERPRINTS = "n long, fingerprint string, listing string, source string, partition_date string"


def fingerprints(rows: DataFrame, by: list[str] = PAIR) -> DataFrame:
    """(by..., n, fingerprint): row count and sum of row hashes of every partition.

    The sum does not depend on the order of rows, their files or the tasks that read them, and counts a
    repeated row as often as it comes. A null and an absent value differ from an empty one.
    """
    columns = sorted(c for c in rows.columns if c not in by)
    # Which values are null goes into the hash, which alone would skip them.
    row = F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])
    total = F.sum(row.cast("decimal(20,0)")).cast("decimal(38,0)")
    return rows.groupBy(*by).agg(F.count("*").alias("n"), total.cast("string").alias("fingerprint"))


def changed_partitions(now: DataFrame, kept: DataFrame, by: list[str] = PAIR) -> DataFrame:
    """Partitions whose fingerprint is not the one kept of them, or that were never kept; nulls in by match.

    Both sides have one row per partition.
    """
    same = [F.col(f"now.{c}").eqNullSafe(F.col(f"kept.{c}")) for c in [*by, "n", "fingerprint"]]
    return now.alias("now").join(kept.alias("kept"), same, "left_anti").select(*by)


def missing_dates(spark: SparkSession, present: DataFrame, start: str, end: str) -> DataFrame:
    """Calendar dates of a closed range absent from a table."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day")
    )
    wanted = days.select(F.col("day").cast("string").alias("partition_date"))
    return wanted.join(present.select("partition_date").distinct(), "partition_date", "left_anti")


def keep_missing(df: DataFrame, missing: DataFrame) -> DataFrame:
    """Rows of the dates still missing from the target; one row per calendar date is broadcast."""
    return df.join(F.broadcast(missing.select("partition_date")), "partition_date", "left_semi")


def merge_refreshed(existing: DataFrame | None, fresh: DataFrame, cutoff: str | None) -> DataFrame:
    """History before the cutoff from the table, everything from it onwards from fresh.

    With no cutoff, or no table yet, fresh is the whole result.
    """
    if cutoff is None or existing is None or "partition_date" not in existing.columns:
        return fresh
    day = F.col("partition_date").cast("string")
    return existing.filter(day < cutoff).unionByName(fresh.filter(day >= cutoff), allowMissingColumns=True)
