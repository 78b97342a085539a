"""Global ranks without gathering rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._storage import saved, scratch


def global_rank(df: DataFrame, order: list, out: str = "place") -> DataFrame:
    """``df`` with ``out`` = 1, 2, ... in the given order.

    Rows are range-partitioned and numbered within their partition; only one count for each
    partition reaches the driver.  The sorted table is written first, so both passes see one order.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, "ranked")
    df = saved(df, "unranked")  # sampling the ranges would compute the input a second time
    df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_p", F.shiftright("_m", 33))
    counts, before = sorted(tuple(r) for r in rows.groupBy("_p").count().collect()), [(-1, 0)]
    total = 0
    for p, n in counts:
        before.append((p, total))
        total += n
    offsets = F.broadcast(spark.createDataFrame(before, "_p long, _before long"))  # one row for each partition
    return rows.join(offsets, "_p").withColumn(out, F.col("_before") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_p", "_m", "_before")
