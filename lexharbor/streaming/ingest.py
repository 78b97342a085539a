"""Incremental stages: only keys that a table lacks are computed, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def append_missing(batch: DataFrame, path: str, key: str, compute: Callable[[DataFrame], DataFrame], batch_id: int = 0) -> None:
    """Compute rows whose key the table at ``path`` lacks, and write them as this batch's part.

    A batch that is run again overwrites its own part, so a restart leaves no row twice.
    """
    spark = batch.sparkSession
    target = f"{path}/batch={batch_id}"
    todo = batch.dropDuplicates([key])
    if _exists(spark, path):
        done = spark.read.parquet(path)
        todo = todo.join(done.where(f"batch <> {batch_id}").select(key), key, "left_anti")
    compute(todo).write.mode("overwrite").parquet(target)


def incremental(stream: DataFrame, path: str, key: str, compute: Callable[[DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """A streaming query that keeps the table at ``path`` complete; processes what is there, then ends."""
    return (
        stream.writeStream.foreachBatch(lambda df, n: append_missing(df, path, key, compute, n))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
