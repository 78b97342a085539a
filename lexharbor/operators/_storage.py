"""Where iterative operators keep intermediate tables: the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh path below the shared folder; a private one only on a local master without any."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = held.get() if held.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="lexharbor-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write and reread: cuts the lineage, and a lost executor does not lose the table."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path of any Hadoop file system, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
