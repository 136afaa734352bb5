"""What the operators of this subpackage share: table reads, scratch tables, columns, worker state."""

from __future__ import annotations

import atexit
import sys
import types

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meltemi.session import scratch_path

# Functions that run in tasks travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Bytes of rows handed to a Python worker at a time; one longer text is a batch of its own.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; from then on texts reach Python in batches bounded by bytes, not only by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed package of public vocabularies has a file; the same on every machine that has it."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Scratch:
    """Written tables in the shared folder, which cut lineage and are deleted when done with.

    A lost executor costs a task: what it had written to the shared folder stays readable.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: list[str] = []

    def write(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self._paths.append(path)
        writer = df.write.partitionBy(*by) if by else df.write
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *frames: DataFrame) -> None:
        """Delete the files of frames that write() returned."""
        for df in frames:
            names = {f.rpartition("/")[0] for f in df.inputFiles()}
            for path in [p for p in self._paths if any(_plain(n).startswith(_plain(p)) for n in names)]:
                self._paths.remove(path)
                delete(self.spark, path)

    def keep(self, path: str) -> None:
        """Count another folder as written here."""
        self._paths.append(path)

    def later(self) -> None:
        """Delete the rest, which a returned frame still reads, when the process ends."""
        _LATER.extend((self.spark, p) for p in self._paths)
        self._paths = []


def _plain(path: str) -> str:
    return "/" + path.split(":", 1)[-1].lstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


_LATER: list[tuple[SparkSession, str]] = []


@atexit.register
def _clean() -> None:
    for spark, path in _LATER:
        if spark.sparkContext._jsc is not None:
            delete(spark, path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of df has it; Spark does not tell capitals apart."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ddl_of(df: DataFrame, *leave_out: str) -> str:
    """The columns of df as DDL, but for those left out."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in leave_out)


def doc_fold(modulus: int):
    """crc32 of doc_id as text, modulo; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def worker_state() -> dict:
    """A dict that outlives a task: one Python worker runs many."""
    return sys.modules.setdefault("meltemi_worker_state", types.ModuleType("meltemi_worker_state")).__dict__


class Recent:
    """A dict that forgets: entries unused for a whole generation go."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def take(self, keys) -> tuple[dict, list]:
        """What is known of the keys, and those that are not."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        known, unknown = {}, []
        for k in keys:
            v = self.new.get(k)
            if v is None:
                v = self.old.get(k)
                if v is None:
                    unknown.append(k)
                    continue
                self.new[k] = v
            known[k] = v
        return known, unknown
