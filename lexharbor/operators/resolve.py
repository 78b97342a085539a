"""Entity resolution by DOI and title similarity, in input order.

A row joins the cluster of the first row with its DOI; otherwise that of the earliest leader with a
similar title (same language, enough tokens); otherwise it leads a cluster of its own.

Only the first row of each DOI takes part in title matching, and of those only the first of each
token set; both facts follow from the order, and keep hot DOIs and hot titles out of the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_doi, title_tokens
from ._storage import saved
from .simjoin import greedy_leaders, similar_pairs


def source_set(df: DataFrame) -> Column:
    """The sources of a row: the plural column if filled, else the singular one."""
    one = F.col("source_database") if "source_database" in df.columns else F.lit(None).cast("string")
    single = F.when(F.coalesce(one, F.lit("")) != "", F.array(one)).otherwise(F.array().cast("array<string>"))
    if "source_databases" not in df.columns:
        return single
    many = F.filter(F.split(F.coalesce("source_databases", F.lit("")), r"\|"), lambda s: s != "")
    return F.when(F.size(many) > 0, many).otherwise(single)


def good_authors(c: Column) -> Column:
    """Not empty and no more than 25 names."""
    return (F.coalesce(c, F.lit("")) != "") & (F.size(F.split(c, ";")) <= 25)


def cluster_leaders(df: DataFrame, order: str = "ord", threshold: float = 0.85, min_tokens: int = 6) -> DataFrame:
    """(ord, leader) for every row."""
    tokens = F.array_sort(title_tokens(F.col("title")))
    rows = saved(
        df.select(
            F.col(order).alias("ord"),
            normalize_doi(F.col("doi")).alias("d"),
            tokens.alias("tokens"),
            F.coalesce(F.lower("language"), F.lit("")).alias("bucket"),
        ),
        "resolve-rows",
    )
    dois = rows.where("d is not null").groupBy("d").agg(F.min("ord").alias("doi_first"))
    # Rows without a DOI take no part in the join: they would all meet in one task.
    rows = rows.where("d is not null").join(dois, "d").unionByName(rows.where("d is null").withColumn("doi_first", F.col("ord")))
    lead = rows.where("ord = doi_first and size(tokens) >= " + str(min_tokens))
    classes = lead.groupBy("bucket", "tokens").agg(F.min("ord").alias("node"))
    classes = saved(classes, "resolve-titles")
    pairs = similar_pairs(classes.select("node", "bucket", "tokens"), None, threshold)
    led = greedy_leaders(pairs)
    titles = lead.select("ord", "bucket", "tokens").join(classes, ["bucket", "tokens"]).join(led, "node", "left")
    titles = titles.select(F.col("ord").alias("doi_first"), F.coalesce("leader", "node").alias("title_leader"))
    return rows.join(titles, "doi_first", "left").select("ord", F.coalesce("title_leader", "doi_first").alias("leader"))


def resolve(df: DataFrame, order: str = "ord", threshold: float = 0.85, min_tokens: int = 6) -> DataFrame:
    """One row per cluster: the leader's columns, repaired authors, united sources; ``order`` is kept."""
    led = cluster_leaders(df, order, threshold, min_tokens)
    facts = df.select(F.col(order).alias("ord"), source_set(df).alias("s"), F.when(good_authors(F.col("authors")), F.col("authors")).alias("g"))
    merged = (
        facts.join(led, "ord")
        .groupBy("leader")
        .agg(
            F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("s")))), "|").alias("source_databases"),
            F.min_by("g", F.when(F.col("g").isNotNull(), F.col("ord"))).alias("_good"),
        )
    )
    out = df.drop("source_databases", "source_database").join(merged, F.col(order) == F.col("leader"))
    fixed = F.when(good_authors(F.col("authors")), F.col("authors")).otherwise(F.coalesce("_good", "authors"))
    return out.withColumn("authors", fixed).drop("leader", "_good")


def first_by(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")


def last_by(df: DataFrame, key: str, order: str) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))).where("_n = 1").drop("_n")


def resolve_plain(records: DataFrame, threshold: float = 0.85, min_tokens: int = 6) -> DataFrame:
    """``resolve`` of rows that have no order column: in the order in which they are read."""
    rows = saved(records.withColumn("_ord", F.monotonically_increasing_id()), "plain")
    return resolve(rows, "_ord", threshold, min_tokens).orderBy("_ord").drop("_ord")
