"""Partitioned writes that can be repeated, each of them one step for a reader.

A write that replaces or removes partitions first stages its rows in a folder of its own and then
publishes a new version of the table: a list of which folders make up each partition, in one file that
appears under its number whole or not at all. A job or driver lost at any moment leaves the table as it
was before the write or as it is after it; what was staged in vain is cleaned up later. Refreshing a
range costs the range: all other partitions go on in the new version by name. Earlier versions stay
readable and can be restored until clean_up() drops them.

A plain append is one Spark commit and needs no version; a table that has versions gets a new one.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meltemi import settings as S
from meltemi.sources import snapshots
from meltemi.sources.snapshots import file_system
from meltemi.sources.tables import check_lead_in, cutoff

DAY = ("partition_date",)
DAY_SOURCE = ("partition_date", "source")
# Spark's folder for a null or empty partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Written:
    rows: int
    partitions: list[str]
    removed: list[str]


class CommitConflict(RuntimeError):
    """Another write published partitions that this one read or replaces."""


def list_partitions(spark: SparkSession, path: str, by: tuple[str, ...] = DAY) -> list[str]:
    """Leaf partition folders, such as partition_date=2024-01-05/source=waqi.

    A directory listing, or the newest version's list: no data file is opened. A missing table has
    none; a listing that fails raises, so a caller never mistakes an unreadable table for a new one.
    """
    found = snapshots.version(spark, path)
    return sorted(found.partitions) if found else _plain_partitions(spark, path, by)


def _plain_partitions(spark: SparkSession, path: str, by: tuple[str, ...]) -> list[str]:
    root, fs = file_system(spark, path)
    if not fs.exists(root):
        return []
    pattern = spark._jvm.org.apache.hadoop.fs.Path(root, "/".join(f"{c}=*" for c in by))
    found = fs.globStatus(pattern)
    names = [str(status.getPath().toString()) for status in (found or [])]
    return sorted("/".join(n.split("/")[-len(by):]) for n in names)


def listings(spark: SparkSession, path: str, by: tuple[str, ...] = DAY) -> dict[str, str]:
    """Per partition, what it is made of: the commits of its version, or names and sizes of its files.

    Equal listings mean equal rows; a partition that was written again has another one, whatever its rows.
    """
    found = snapshots.version(spark, path)
    if found:
        return {p: ",".join(sorted(commits)) for p, commits in found.partitions.items()}
    out = {}
    for p in _plain_partitions(spark, path, by):
        folder, fs = file_system(spark, f"{path.rstrip('/')}/{p}")
        files = sorted(f"{s.getPath().getName()}:{s.getLen()}" for s in fs.listStatus(folder))
        out[p] = hashlib.sha256("|".join(files).encode()).hexdigest()
    return out


def folder_day(folder: str) -> str | None:
    """Date of a partition folder as the table's readers see it; None for a null one."""
    value = folder.split("/")[0].split("=", 1)[1]
    return None if value == NULL_FOLDER else unquote(value)


def partition_days(partitions: list[str]) -> list[str]:
    return sorted({day for p in partitions if (day := folder_day(p)) is not None})


def folder_name(spark: SparkSession, values: dict[str, str | None]) -> str:
    """Folder of a partition, named and escaped by the rules Spark writes it with."""
    paths = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(paths.getPartitionPathString(c, v) for c, v in values.items())


def _tracked(df: DataFrame, by: tuple[str, ...]) -> tuple[DataFrame, Observation]:
    """Row count and touched partitions, gathered by the write itself instead of a second job.

    The set holds one entry per partition written, which the calendar bounds.
    """
    values = F.struct(*[F.col(c).cast("string").alias(c) for c in by])
    seen = Observation()
    # Rebalancing gathers each partition's rows into few files; AQE splits a partition that
    # holds most of the rows and merges the tiny ones.
    tracked = df.hint("rebalance", *by).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.collect_set(values).alias("partitions")
    )
    return tracked, seen


def append(df: DataFrame, path: str, by: tuple[str, ...] = DAY_SOURCE) -> Written:
    """Append once for the whole batch; readers merge any new column by name."""
    if snapshots.versions(df.sparkSession, path):
        return _publish(df, path, by, "append", lambda held, fresh: ({**held, **{p: [*held.get(p, []), *c] for p, c in fresh.items()}}, []))
    return _plain_append(df, path, by)


def _plain_append(df: DataFrame, path: str, by: tuple[str, ...]) -> Written:
    tracked, seen = _tracked(df, by)
    tracked.write.mode("append").partitionBy(*by).parquet(path)
    got = seen.get
    return Written(got["rows"], _folders(df.sparkSession, got["partitions"]), [])


def _folders(spark: SparkSession, partitions: list) -> list[str]:
    return sorted(folder_name(spark, row.asDict()) for row in partitions)


def stage(df: DataFrame, path: str, by: tuple[str, ...]) -> tuple[str, Written]:
    """Rows in a folder of their own, which no reader sees."""
    commit = uuid.uuid4().hex
    return commit, _plain_append(df, snapshots.commit_path(path, commit), by)


def put_version(spark: SparkSession, path: str, new: snapshots.Version) -> bool:
    """Publish a version; False when its number is taken. The file is written aside and renamed, which
    never replaces one that is there."""
    final = snapshots.version_path(path, new.number)
    aside, fs = file_system(spark, f"{path.rstrip('/')}/{snapshots.VERSIONS}/.{uuid.uuid4().hex}.json")
    stream = fs.create(aside, False)
    try:
        stream.write(json.dumps(asdict(new)).encode())
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(aside, file_system(spark, final)[0], options)
    except Py4JJavaError as error:
        fs.delete(aside, False)
        if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
            return False
        raise
    return True


Change = Callable[[dict[str, list[str]], dict[str, list[str]]], tuple[dict[str, list[str]], list[str]]]


def _publish(df: DataFrame, path: str, by: tuple[str, ...], operation: str, change: Change) -> Written:
    """Stage df, then publish what `change` makes of the held and the fresh partitions.

    Of two writes that end at once one takes the number; the other looks again. It goes on if no
    partition that it changes or removes was changed meanwhile, else it raises and the table stays.
    """
    spark = df.sparkSession
    seen = snapshots.version(spark, path)
    was = held = seen.partitions if seen else {p: [snapshots.PLAIN] for p in _plain_partitions(spark, path, by)}
    commit, written = stage(df, path, by)
    fresh = {p: [commit] for p in written.partitions}
    while True:
        after, removed = change(held, fresh)
        clash = sorted(p for p in set(fresh) | set(removed) if held.get(p) != was.get(p))
        if clash and operation != "append":
            raise CommitConflict(f"{path}: {', '.join(clash[:5])} changed while this write ran")
        new = snapshots.Version(
            seen.number + 1 if seen else 1, operation, datetime.now(timezone.utc).isoformat(timespec="seconds"), written.rows, after,
            sorted(fresh), removed)
        if put_version(spark, path, new):
            return Written(written.rows, written.partitions, removed)
        seen = snapshots.version(spark, path)
        held = seen.partitions


def replace_partitions(df: DataFrame, path: str, by: tuple[str, ...] = DAY_SOURCE) -> Written:
    """Overwrite the partitions that df has rows for, and no others."""
    return _publish(df, path, by, "replace partitions", lambda held, fresh: ({**held, **fresh}, []))


def exchange(df: DataFrame, path: str, old: list[str], by: tuple[str, ...] = DAY_SOURCE) -> Written:
    """Put df's partitions in the place of the named ones, in one step."""

    def change(held: dict, fresh: dict) -> tuple[dict, list[str]]:
        gone = sorted(p for p in old if p in held and p not in fresh)
        return {**{p: c for p, c in held.items() if p not in gone}, **fresh}, gone

    return _publish(df, path, by, "exchange", change)


def replace_range(
    df: DataFrame, path: str, start: str | None, end: str | None, by: tuple[str, ...] = DAY, operation: str = "replace range",
) -> Written:
    """Replace exactly the partition dates in [start, end]; an open end is unbounded."""

    def inside(day: str | None) -> bool:
        # A null date is in no bounded range.
        if day is None:
            return start is None and end is None
        return (start is None or day >= start) and (end is None or day <= end)

    rows = df
    if start is not None:
        rows = rows.filter(F.col("partition_date") >= start)
    if end is not None:
        rows = rows.filter(F.col("partition_date") <= end)

    def change(held: dict, fresh: dict) -> tuple[dict, list[str]]:
        removed = sorted(p for p in held if inside(folder_day(p)) and p not in fresh)
        kept = {p: c for p, c in held.items() if not inside(folder_day(p))}
        return {**kept, **fresh}, removed

    return _publish(rows, path, by, operation, change)


def overwrite(df: DataFrame, path: str, by: tuple[str, ...] = DAY) -> Written:
    """Whole-table rebuild: readers see the old table until the new one is there."""
    return replace_range(df, path, None, None, by, "overwrite")


def restore(spark: SparkSession, path: str, number: int) -> snapshots.Version:
    """Make an earlier version the newest again; no data file is read or written."""
    old = snapshots.version(spark, path, number)
    while True:
        last = snapshots.version(spark, path)
        changed = sorted(p for p, c in old.partitions.items() if last.partitions.get(p) != c)
        new = snapshots.Version(
            last.number + 1, f"restore {number}", datetime.now(timezone.utc).isoformat(timespec="seconds"), 0, old.partitions, changed,
            sorted(set(last.partitions) - set(old.partitions)))
        if put_version(spark, path, new):
            return new


def clean_up(spark: SparkSession, path: str, keep: int = 10, idle_hours: float = 24.0) -> dict[str, int]:
    """Drop all but the newest `keep` versions, and the folders none of the kept ones names.

    Folders younger than idle_hours stay: a running write may be about to publish them, and a reader
    may still be in them.
    """
    numbers = snapshots.versions(spark, path)
    kept = [snapshots.version(spark, path, n) for n in numbers[-keep:]]
    if not kept:
        return {"versions": 0, "folders": 0}
    # Version files go first: a version whose folders are gone must not be read.
    for n in numbers[:-keep]:
        target, fs = file_system(spark, snapshots.version_path(path, n))
        fs.delete(target, False)
    used = {f"{snapshots.COMMIT}={c}/{p}" for v in kept for p, commits in v.partitions.items() for c in commits if c != snapshots.PLAIN}
    root, fs = file_system(spark, f"{path.rstrip('/')}/{snapshots.DATA}")
    depth = len(next((p for v in kept for p in v.partitions), "").split("/"))
    oldest = (time.time() - 3600 * idle_hours) * 1000
    dropped = 0
    pattern = spark._jvm.org.apache.hadoop.fs.Path(root, "/".join([f"{snapshots.COMMIT}=*", *["*=*"] * depth]))
    for status in fs.globStatus(pattern) or []:
        name = "/".join(str(status.getPath().toString()).split("/")[-depth - 1:])
        if name not in used and status.getModificationTime() < oldest:
            fs.delete(status.getPath(), True)
            dropped += 1
    return {"versions": len(numbers[:-keep]), "folders": dropped}


def refresh(
    fresh: DataFrame, path: str, as_of: str, refresh_days: int | None = S.REFRESH_DAYS,
    window_days: int | None = S.WINDOW_DAYS, by: tuple[str, ...] = DAY,
) -> Written:
    """Rolling Gold refresh: the last refresh_days are replaced, older partitions are kept.

    Rows of fresh before the cutoff are lead-in for baselines and are not written, except
    into a table that does not exist yet, which takes fresh whole.
    """
    check_lead_in(window_days, refresh_days)
    first = cutoff(as_of, refresh_days)
    if first is None or not list_partitions(fresh.sparkSession, path, by):
        return overwrite(fresh, path, by)
    return replace_range(fresh, path, first, None, by, "refresh")
