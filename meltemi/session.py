"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE re-plans shuffles from real sizes: it coalesces small partitions, splits skewed join
# partitions and only broadcasts a side whose measured size is under the threshold.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partition_date is a string everywhere; Spark would otherwise infer DATE from paths.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "meltemi", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the settings results depend on, on a session someone else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder the cluster names in spark.checkpoint.dir.

    A machine-local folder is only ever used by a local master, where driver and executors
    share one disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="meltemi-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark, path))
    return path


_SCRATCH: list[tuple[SparkSession, str]] = []


@atexit.register
def delete_scratch() -> None:
    """Delete every path scratch_path has handed out; it runs when the process ends."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        if spark.sparkContext._jsc is None:
            continue
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
