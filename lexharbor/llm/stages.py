"""The stages of the training-data pipeline, each ``(spark, docs, sf_dir) -> DataFrame``.

Every stage reads the rows that its predecessor kept and returns rows of the same columns, the last
one a row for each document of the mix.

Defined results, in every stage: rows are judged one by one, whatever their identifier is.  Where a
key is needed and ``doc_id`` is null or repeats, the row gets a number of its own above all
identifiers (in the order of identifier and text); the first row of an identifier keeps it.  Null and empty texts have no letter and are
rejected by the first stage; very long texts are judged whole; ties are settled by identifier, then
text; an empty table gives an empty result; extra columns, whatever their names, are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, langid, mixing, near_dedup, packing
from .common import dense_index, filter_bits, joined_spread, settle, with_membership, without

SHARDS = 24


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in a learned language; ``und`` and texts that no language foresees go."""
    return langid.keep_known_language(docs)


def keyed(docs: DataFrame) -> DataFrame:
    """(row, key): each row whole, and ``doc_id`` in its first row, else a number of its own above all identifiers."""
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("key"))
    odd = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or key is null").select(F.col("key").alias("odd"), "n")
    odd = settle(odd, "odd-ids")
    if odd.isEmpty():
        return rows
    named = odd.where("odd is not null").select("odd")
    judged = with_membership(rows.where("key is not null"), "key", named, "odd", "maybe", filter_bits(named.count()))
    # Identifiers repeat seldom or often: rows of one that is hot are dealt over shares.
    maybe = settle(judged.where("maybe").drop("maybe"), "odd-maybe")
    marked = joined_spread(maybe, named.select(F.col("odd").alias("key"), F.lit(True).alias("again")), "key", F.xxhash64("row.text"), "left")
    plain = judged.where("not maybe").drop("maybe").unionByName(marked.where("again is null").drop("again"))
    rest = marked.where("again").drop("again").unionByName(rows.where("key is null"))
    top = rows.agg(F.max("key")).first()[0]
    rest = dense_index(rest, [F.col("key").asc_nulls_last(), F.col("row.text")], "odd-rows", "place")
    firsts = rest.where("key is not null").groupBy("key").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    above = F.col("place") + F.lit(0 if top is None else top + 1).cast("long")
    rest = rest.join(firsts, "place", "left").select("row", F.when(F.col("first"), F.col("key")).otherwise(above).alias("key"))
    return plain.unionByName(rest)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group (five-word shingles, similarity 0.8): the one with the smallest key."""
    rows = keyed(docs)
    found = near_dedup.near_duplicates(rows.select("key", "row.text"), words=5, percent=80, id_col="key")
    gone = found.where(F.col("component").isNotNull() & (F.col("id") != F.col("component"))).select("id")
    return without(rows, "key", gone, "id").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a confirmed passage of the benchmark."""
    rows = keyed(docs)
    leaks = decontaminate.find_leaks(rows.select("key", "row.text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="key")
    return without(rows, "key", leaks, "id").select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the mix takes, as often as it takes them (once or twice)."""
    mixed = mixing.mix_sources(docs, keep=True).where("copies > 0")
    return mixed.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of the mix."""
    out = packing.shard_documents(docs, SHARDS)
    return out.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), "shard", "slot")
