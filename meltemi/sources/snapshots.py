"""Tables with versions: which folders a version is made of, and reads of the newest or an earlier one.

Below a table's path, `_data/commit=<id>/<partition folders>` holds what each write staged, and
`_versions/<number>.json` names, for every partition, the commits whose folders belong to it. A version
is one small file that appears whole or not at all, so a reader sees a table as it was before a write
or after it. Partitions written there before the table had versions keep their place: their commit is
the empty one.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

VERSIONS, DATA = "_versions", "_data"
COMMIT = "commit"
#: Where a table's folders were before it had versions.
PLAIN = ""


@dataclass(frozen=True)
class Version:
    number: int
    operation: str
    written_at: str
    rows: int
    #: Partition folder to the commits that hold its rows.
    partitions: dict[str, list[str]]
    changed: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)


class NoVersion(LookupError):
    """The version asked for was never written or has been cleaned away."""


def file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def version_path(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{VERSIONS}/{number:012d}.json"


def commit_path(path: str, commit: str) -> str:
    root = path.rstrip("/")
    return root if commit == PLAIN else f"{root}/{DATA}/{COMMIT}={commit}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions kept, oldest first; none for a table without versions."""
    folder, fs = file_system(spark, f"{path.rstrip('/')}/{VERSIONS}")
    if not fs.exists(folder):
        return []
    names = [str(s.getPath().getName()) for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")


def read_text(spark: SparkSession, path: str) -> str:
    target, fs = file_system(spark, path)
    stream = fs.open(target)
    try:
        return str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The newest version or the one asked for; None for a table without versions."""
    kept = versions(spark, path)
    if number is None:
        if not kept:
            return None
        number = kept[-1]
    elif number not in kept:
        raise NoVersion(f"{path} has no version {number}")
    return Version(**json.loads(read_text(spark, version_path(path, number))))


def read_folders(
    spark: SparkSession, path: str, found: Version, partitions: list[str] | None = None, ddl: str | None = None, merge: bool = False
) -> DataFrame:
    """Scan of a version's folders, of all partitions or the named ones; no other folder is listed."""
    named = found.partitions if partitions is None else {p: found.partitions[p] for p in partitions if p in found.partitions}
    plain = [f"{commit_path(path, PLAIN)}/{p}" for p, commits in named.items() if PLAIN in commits]
    kept = [f"{commit_path(path, c)}/{p}" for p, commits in named.items() for c in commits if c != PLAIN]
    frames = []
    for base, folders in ((path, plain), (f"{path.rstrip('/')}/{DATA}", kept)):
        if folders:
            reader = spark.read.option("basePath", base).option("mergeSchema", str(merge).lower())
            if ddl:
                reader = reader.schema(ddl)
            frames.append(reader.parquet(*folders).drop(COMMIT))
    if frames:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if ddl:
        return spark.createDataFrame([], ddl)
    # The columns of a table all of whose partitions have gone are those of its last commit.
    last = next((v for n in reversed(versions(spark, path)) if (v := version(spark, path, n)).partitions), None)
    if last is None:
        raise NoVersion(f"{path} never had a row, so its columns are not known")
    return read_folders(spark, path, last).limit(0)


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row per version kept."""
    rows = [(v.number, v.operation, v.written_at, v.rows, len(v.partitions), len(v.changed), len(v.removed))
            for n in versions(spark, path) if (v := version(spark, path, n))]
    return spark.createDataFrame(
        rows, "version int, operation string, written_at string, rows long, partitions int, changed int, removed int")
