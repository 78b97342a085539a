"""Citation edges: seeds, citing works, cited works."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_match(candidates: DataFrame, group: str, year_hint: Column, limit: int = 25, order: str = "pos") -> DataFrame:
    """The candidate of each group nearest to the hinted year, then most cited; the first on ties."""
    rank = F.struct(
        F.when(year_hint.isNotNull(), -F.abs(F.coalesce("publication_year", F.lit(0)) - year_hint)).otherwise(0).alias("near"),
        F.coalesce("cited_by_count", F.lit(0)).alias("cited"),
        (-F.col(order)).alias("first"),
    )
    w = Window.partitionBy(group).orderBy(order)
    top = candidates.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= limit).drop("_n")
    return top.groupBy(group).agg(F.max_by("id", rank).alias("id"))


def seeds_from_labels(df: DataFrame, n: int = 20) -> DataFrame:
    """The n core records with the best scores, nulls last."""
    return df.where("relevance_llm = 'core'").orderBy(F.col("embed_score").desc_nulls_last(), "id").limit(n)


def forward(edges: DataFrame, seeds: DataFrame, cap: int = 500, order: str = "ord") -> DataFrame:
    """Works (src) that cite a seed (dst), at most ``cap`` a seed in order, each work once."""
    hit = edges.join(seeds.select(F.col("id").alias("dst")).distinct(), "dst", "left_semi")
    w = Window.partitionBy("dst").orderBy(order, "src")
    return hit.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= cap).select(F.col("src").alias("id")).distinct()


def backward(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Works (dst) that a seed (src) cites, each once."""
    return edges.join(seeds.select(F.col("id").alias("src")).distinct(), "src", "left_semi").select(F.col("dst").alias("id")).distinct()
