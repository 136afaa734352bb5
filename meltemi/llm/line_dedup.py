"""Line dedup over levelled sorted runs.

A run is a table of line hashes with the number of documents that hold each, sorted by hash. A new
batch is merge-joined against the runs: hashes already common there are settled and left out, the
others form a run of level 0. When a level has as many runs as the fan-out, they are merged into one
run of the next level, so n batches leave about log n runs, and a batch is written a few times in all.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meltemi.llm.common import Scratch, ddl_of, unused
from meltemi.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY = ["hi", "lo"]
OUTPUT = ["n_lines", "n_dropped", "kept_sha256", "kept_text"]


def line_key(line: bytes) -> bytes:
    """White space of ASCII stripped at both ends, A-Z lower-cased."""
    return line.strip(b" \t\n\x0b\x0c\r").lower()


def split_lines(text: bytes | None) -> list[bytes]:
    return (text or b"").split(b"\n")


def _hash_batches(min_chars: int):
    """(t, hi, lo) for each document's distinct keys of at least min_chars code points; t names its text.

    Rows are (name, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            digests, n = [], []
            for text in batch.column(1):
                keys = {line_key(x) for x in split_lines(text.as_py())}
                keys = [k for k in keys if _chars(k) >= min_chars]
                digests += map(xxhash.xxh3_128_digest, keys)
                n.append(len(keys))
            names = np.repeat(batch.column(0).to_numpy(), n)
            hashes = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(names), *(pa.array(h.copy()) for h in hashes.T)], names=["t", *KEY])

    return run


def _chars(key: bytes) -> int:
    return len(key) - sum(0x80 <= b < 0xC0 for b in key) if not key.isascii() else len(key)


def _named(text: str) -> tuple[Column, Column]:
    """A hash of the text that copies share, and the text as bytes."""
    body = F.coalesce(F.col(text), F.lit(""))
    return F.xxhash64(body), body.cast("binary")


def line_hashes(docs: DataFrame, min_chars: int = 1, text: str = "text") -> DataFrame:
    """(t, hi, lo): one row per document and distinct line key; the key as a 128-bit hash."""
    rows = docs.select(*_named(text))
    return rows.mapInArrow(_hash_batches(min_chars), "t long, hi long, lo long")


class LineRuns:
    """Levelled runs of line hashes with their document counts, in the shared folder.

    A run is stored in buckets by hash, one sorted file each. All runs have the same buckets, so a batch
    is dealt once and then merge-joined with each run as it lies, and runs are merged bucket by bucket,
    without another shuffle.
    """

    def __init__(self, spark: SparkSession, min_docs: int, fan_out: int = 4):
        self.spark, self.min_docs, self.fan_out = spark, min_docs, fan_out
        self.scratch = Scratch(spark)
        self.levels: list[list[str]] = []
        # A batch's counts are dealt by as many partitions, so they meet the buckets as they are.
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # The files of a run are read in the order they were written in.
        spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")

    def names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for name in self.names()]

    def counts(self) -> DataFrame:
        """(hi, lo, n_docs) over all runs."""
        empty = self.spark.createDataFrame([], "hi long, lo long, n_docs long")
        return self._merged(self.runs()) if self.levels else empty

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        # The filter passes all rows. It makes rows of a scan's column batches, of which Spark's union would lay the
        # buckets end to end and yet have the aggregate take equal buckets as met.
        rows = [run.filter("n_docs > 0") for run in runs]
        return reduce(DataFrame.unionByName, rows).groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"))

    def common(self) -> DataFrame:
        """(hi, lo) of the lines held by min_docs documents or more."""
        return self.counts().filter(F.col("n_docs") >= self.min_docs).select(*KEY)

    def unsettled(self, hashes: DataFrame) -> DataFrame:
        """Counts of a batch of line_hashes, but for keys that some run alone has often enough."""
        batch = hashes.groupBy(*KEY).agg(F.count("*").alias("n_docs"))
        for run in self.runs():
            batch = batch.join(run.filter(F.col("n_docs") >= self.min_docs).hint("merge"), KEY, "left_anti")
        return batch

    def add(self, hashes: DataFrame) -> None:
        """Count a batch of line_hashes: its keys that no single run settles become a run."""
        self._push(self.unsettled(hashes), 0)

    def _push(self, counted: DataFrame, level: int) -> None:
        name, path = f"line_run_{uuid.uuid4().hex}", scratch_path(self.spark, f"run-{level}")
        self.scratch.keep(path)
        counted.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fan_out:
            self._compact(level)

    def _compact(self, level: int) -> None:
        old = self.levels[level]
        self.levels[level] = []
        self._push(self._merged([self.spark.table(name) for name in old]), level + 1)
        self._drop(old)

    def _drop(self, names: list[str]) -> None:
        self.scratch.drop(*[self.spark.table(name) for name in names])
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def drop(self) -> None:
        """Delete all runs."""
        self._drop(self.names())
        self.levels = []


def _drop_batches(texts: bool, own: str, held: str):
    """Drop the lines whose hash is among the row's common ones, in the column `held`; the text is in `own`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        import xxhash

        for batch in batches:
            total, gone, digests, bodies = [], [], [], []
            for text, common in zip(batch.column(own), batch.column(held)):
                body = text.as_py()
                lines = split_lines(body)
                total.append(len(lines))
                if common.is_valid:
                    dropped = {np.array([c["hi"], c["lo"]], dtype="<i8").tobytes() for c in common.as_py()}
                    lines = [x for x in lines if xxhash.xxh3_128_digest(line_key(x)) not in dropped]
                    body = b"\n".join(lines)
                gone.append(total[-1] - len(lines))
                digests.append(hashlib.sha256(body).hexdigest())
                bodies.append(body.decode("utf-8", "replace") if texts else None)
            kept = [c for c in batch.schema.names if c not in (own, held)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(bodies, pa.string())], names=[*kept, *OUTPUT])

    return run


def drop_common_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fan_out: int = 4,
    text: str = "text", texts: bool = True,
) -> DataFrame:
    """Every row with n_lines, n_dropped, kept_sha256 and kept_text (null unless `texts`).

    A text is split at line feeds; a line whose key (ASCII white space stripped at both ends, A-Z
    lower-cased) has min_chars code points and stands in min_docs documents or more is dropped
    everywhere. A null or empty text is one empty line. Rows count as documents, repeated rows too;
    a line repeated inside a document counts once. Other columns are kept, except those named as an
    output. An empty table gives an empty result.

    Documents come in `batches`, by a hash of their text, as they would on different days.
    """
    scratch = Scratch(docs.sparkSession)
    hashes = line_hashes(docs, min_chars, text).withColumn("batch", F.pmod("t", F.lit(batches)).cast("int"))
    hashes = scratch.write(hashes, "lines", "batch")
    runs = LineRuns(docs.sparkSession, min_docs, fan_out)
    for b in range(batches):
        runs.add(hashes.filter(F.col("batch") == b))
    # Only the common lines' places travel on; a text's list is as long as its distinct common lines.
    named, body, common = unused(docs, "_t", "_body", "_common")
    # Stored plainly, so that Spark sees its size and can split the partition of a line most documents have.
    common_lines = scratch.write(runs.common(), "common")
    runs.drop()
    held = hashes.join(common_lines, KEY).groupBy(F.col("t").alias(named)).agg(F.collect_set(F.struct(*KEY)).alias(common))
    held = scratch.write(held, "held")
    scratch.drop(hashes, common_lines)
    rows = docs.withColumns(dict(zip((named, body), _named(text)))).drop(*OUTPUT)
    rows = rows.join(held.hint("shuffle_hash"), named, "left").drop(named)
    out = rows.mapInArrow(
        _drop_batches(texts, body, common), f"{ddl_of(rows, body, common)}, n_lines long, n_dropped long, kept_sha256 string, kept_text string")
    scratch.later()
    return out
