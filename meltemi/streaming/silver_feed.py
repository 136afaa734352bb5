"""New Bronze files to Silver: every partition a file touches is built anew."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meltemi.operators.sinks import DAY_SOURCE, replace_partitions
from meltemi.schemas import BRONZE_AIR
from meltemi.sources.tables import read_table


def bronze_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(BRONZE_AIR).parquet(path)


def write_silver(
    bronze: DataFrame, bronze_path: str, silver_path: str, checkpoint: str, build: Callable[[DataFrame], DataFrame]
) -> StreamingQuery:
    """Rows that arrive late for a date and source join those that came before.

    A batch names the partitions it touches, at most one per source and day; all their Bronze rows
    are read again and replace the partition in Silver, so a repeated batch changes nothing.
    """

    def load(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        touched = batch.select(*DAY_SOURCE).distinct()
        days = [row.partition_date for row in touched.select("partition_date").distinct().collect()]
        if not days:
            return
        rows = read_table(spark, bronze_path, F.col("partition_date").isin(days), BRONZE_AIR)
        rows = rows.join(F.broadcast(touched), list(DAY_SOURCE), "left_semi")
        replace_partitions(build(rows), silver_path, DAY_SOURCE)

    return (
        bronze.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
