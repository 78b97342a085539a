"""Connected parts of large graphs, and joins of hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._storage import saved

#: Rows of one key in one share; fewer than HOT_KEYS keys can be dealt over shares.
SHARE_ROWS, HOT_KEYS = 4096, 1 << 16


def spread_join(rows: DataFrame, table: DataFrame, key: str, count: str, salt: str | Column, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``: one row for each ``key``, with its ``count`` among ``total`` rows.

    Rows of a key with more than SHARE_ROWS rows (and more than a HOT_KEYS-th of all) are dealt by ``salt``
    over shares, each of which gets the key's row of ``table``.  Only hot keys are broadcast.
    """
    limit = max(SHARE_ROWS, total // HOT_KEYS)
    shares = F.ceil(F.col(count) / SHARE_ROWS)
    hot = table.where(F.col(count) > limit).select(F.col(key).alias("_hot"), shares.alias("_shares"))
    dealt = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    dealt = dealt.withColumn("_share", F.coalesce(F.pmod(F.xxhash64(salt), "_shares"), F.lit(0).cast("long"))).drop("_hot", "_shares")
    every = F.sequence(F.lit(0).cast("long"), F.when(F.col(count) > limit, shares).otherwise(1).cast("long") - 1)
    return dealt.join(table.withColumn("_share", F.explode(every)), [key, "_share"], how).drop("_share")


def parts(edges: DataFrame, tag: str = "parts") -> tuple[DataFrame, int]:
    """((node, part), rounds): the smallest node that each node of ``edges`` (a, b) reaches.

    Large-star and small-star steps in turn: neighbours above a node move to its smallest neighbour, then
    those below; where nodes are left that are neither a root nor below one, they skip a step.  The number
    of rounds grows with the logarithm of the largest part; of a node only its smallest neighbour is
    gathered, and its edges meet that in shares.
    """
    now = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), tag)
    count, n, rounds = F.count(F.lit(1)).alias("n"), now.count(), 0
    while True:
        rounds += 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = saved(both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"), count), tag)
        moved = spread_join(both, low, "u", "n", "v", 2 * n).where("v > u")
        moved = saved(moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), tag)
        low = saved(moved.groupBy("u").agg(F.min("v").alias("m"), count), tag)
        below = spread_join(moved, low, "u", "n", "v", n).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = saved(below.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), tag)
        n, nodes = now.agg(F.count(F.lit(1)), F.count_distinct("u")).first()
        # Done when all nodes but roots have one neighbour, a root.
        tops = now.groupBy("u").agg(F.min("v").alias("top")).withColumnRenamed("u", "v")
        below = now.groupBy("v").agg(count).join(tops, "v")
        if n == nodes and below.isEmpty():
            break
        below = saved(below, tag)
        skipped = spread_join(now, below, "v", "n", "u", n, "left").select("u", F.coalesce("top", "v").alias("v"))
        now = saved(skipped.distinct(), tag)
        n = now.count()
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("part")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("part")).unionByName(roots), rounds
