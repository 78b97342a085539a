"""Exact deduplication by a log-structured merge index (DataFrame functions only).

Memtables (input partitions, pre-aggregated) flush runs sorted by digest; every run has a filter
of its own.  A digest that no other run's filter knows, and that its own run holds once, is proven
unique; the rest go through compaction, which keeps the smallest identifier of each digest.  Hits,
i.e. rows whose digest more than one row has, are verified byte by byte against the row that stays.

Defined results: null text counts as empty; null identifiers sort after all others and stay
only where every copy's identifier is null; rows that repeat the identifier that stays are the
same document and are all kept; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bit_is_set, bit_slot, for_shares, scratch, settle, spread_join, squeezed, with_membership, with_shares

#: Filter bits for each digest of the index.
BITS_PER_KEY = 16
#: Runs that one ingest flushes; memtables share them.
RUNS = 8


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


class LsmIndex:
    """Digest index in the shared folder: level 0 runs, their filters, and compacted hits."""

    def __init__(self, spark: SparkSession, runs: int = RUNS, bits_per_key: int = BITS_PER_KEY):
        self.spark, self.runs, self.bits_per_key = spark, runs, bits_per_key
        self.root = scratch(spark, "lsm")
        self.n = 0

    def flush(self, rows: DataFrame) -> None:
        """Write ``rows`` (digest, id) as sorted runs; a memtable is an input partition."""
        table = (
            rows.withColumn("run", F.pmod(F.spark_partition_id(), F.lit(self.runs)))
            .groupBy("run", "digest")
            .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
        )
        (
            table.sortWithinPartitions("run", "digest")
            .write.mode("append")
            .option("parquet.bloom.filter.enabled#digest", "true")
            .parquet(f"{self.root}/level0")
        )

    def level0(self) -> DataFrame:
        return self.spark.read.schema("run int, digest string, id long, n long").parquet(f"{self.root}/level0")

    def contains(self, digest: str) -> bool:
        """Point lookup: sorted runs and Parquet's own filters prune the row groups."""
        return not self.level0().where(F.col("digest") == digest).isEmpty()

    def _doubtful(self) -> DataFrame:
        """Digests that another run may hold, or that their own run has more than once."""
        runs = self.level0()
        bits = max(32768, self.bits_per_key * runs.count())
        slot = bit_slot(F.col("digest"), bits)
        keyed = runs.withColumn("slot", slot).withColumn("page", F.bitmap_bucket_number("slot"))
        filters = (
            keyed.groupBy("page", "run")
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("slot"))).alias("bits"))
            .groupBy("page")
            .agg(F.collect_list(F.struct("run", "bits")).alias("filters"))  # one for each run
        )
        seen = F.exists("filters", lambda f: (f["run"] != F.col("run")) & bit_is_set(f["bits"], F.col("slot")))
        return keyed.join(filters, "page").where((F.col("n") > 1) | seen).select("digest", "id", "n")

    def compact(self) -> DataFrame:
        """Hits (digest, keep_id, n): the smallest identifier of each digest that has copies."""
        merged = self._doubtful().groupBy("digest").agg(F.min("id").alias("keep_id"), F.sum("n").alias("n"))
        return settle(merged.where(F.col("n") > 1), "lsm-hits")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256_hex,
) -> DataFrame:
    """One row per input row: id, digest, keep_id, group_size, kept.

    ``digest`` maps the normalised text to a key; whatever it is, equality is decided on bytes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), squeezed(F.col(text_col)).alias("norm"))
    rows = rows.withColumn("digest", digest(F.col("norm")))
    index = LsmIndex(spark)
    index.flush(rows.select("digest", "id"))
    hits = index.compact()

    # The texts of possible hits only; all other rows keep their digest.  Rows of a hot digest are dealt
    # over shares before their texts move.
    total = index.level0().agg(F.sum("n")).first()[0] or 0
    seen = with_shares(with_membership(rows, "digest", hits, "digest", "maybe"), hits, "digest", "n", "id", total)
    seen = settle(seen.select("id", "digest", "maybe", "_share", F.when(F.col("maybe"), F.col("norm")).alias("norm")), "lsm-rows")
    single = seen.where(~F.col("maybe")).select("id", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))

    # Each hit meets the text of the row that stays.
    maybe = seen.where("maybe")
    stays = hits.select(F.col("digest").alias("of"), "keep_id", "n", F.xxhash64("digest", "keep_id").alias("spot"))
    likely = with_membership(maybe.select("id", "digest", "norm", F.xxhash64("digest", "id").alias("at")), "at", stays, "spot", "stays").where("stays")
    same_row = (F.col("digest") == F.col("of")) & F.col("id").eqNullSafe(F.col("keep_id"))
    kept_text = likely.select("id", "digest", "norm").join(stays.drop("spot"), same_row).groupBy("digest", "keep_id", "n").agg(F.min("norm").alias("kept_norm"))
    judged = maybe.join(for_shares(kept_text, "n", total), ["digest", "_share"], "left").withColumn("same", F.col("norm").eqNullSafe(F.col("kept_norm")))
    judged = settle(
        judged.select("id", "digest", "keep_id", "n", "same", F.when(~F.col("same"), F.col("norm")).alias("norm")), "lsm-judged"
    )
    false_hit = judged.where("n is null").select("id", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    same = judged.where("n is not null and same")
    out = single.unionByName(false_hit)
    # Texts that share a digest but not their bytes are classes of their own.
    other = judged.where("n is not null and not same")
    if other.isEmpty():
        out = out.unionByName(same.select("id", "digest", "keep_id", F.col("n").alias("group_size")))
    else:
        classes = other.groupBy("digest", "norm").agg(F.min("id").alias("own_id"), F.count(F.lit(1)).alias("own_n"))
        apart = other.groupBy("digest").agg(F.count(F.lit(1)).alias("apart"), F.first("n").alias("n"))
        same = spread_join(same.select("id", "digest", "keep_id", F.col("n").alias("all")), apart, "digest", "n", "id", total, "left")
        out = out.unionByName(same.select("id", "digest", "keep_id", (F.col("all") - F.coalesce("apart", F.lit(0))).alias("group_size")))
        out = out.unionByName(other.join(classes, ["digest", "norm"]).select("id", "digest", F.col("own_id").alias("keep_id"), F.col("own_n").alias("group_size")))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))
