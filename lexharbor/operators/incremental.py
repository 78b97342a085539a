"""Resolution of new rows against a kept index of leaders, instead of the whole corpus again.

The index is three tables of a folder:

* ``rarity`` (token, df): an order of title tokens, fixed when the index is built.  Any fixed order makes
  the prefixes of two similar sets share a token; tokens that it does not know come first, as the rarest.
* ``dois`` (d, leader) and ``titles`` (node, bucket, n, token, tokens): what each DOI belongs to, and the
  prefix tokens of each leader, in one folder for each batch of rows.

New rows come after all rows of the index in order.  So no leader of the index changes: a new row joins
the cluster of its DOI, else the earliest leader with a similar title, and only rows that find neither
are clustered among themselves.  The result is that of resolving all rows together.

Rows of the index and of the main table that no new row can need are told by filters of a fixed size and
stay where they are, so what is shuffled is in proportion to the new rows.  A batch that runs again
overwrites its own part and sees earlier ones only.  The order of tokens ages: rebuild the index when
most tokens of new titles are unknown to it (that costs time, never a link).

Defined results: rows without DOI and title lead clusters of their own; repeated rows join the first of
them; an empty batch changes nothing; ``order`` is unique, and a batch that does not come after the index
is refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_doi, title_tokens
from ._storage import exists, saved
from .resolve import cluster_leaders, good_authors, resolve, source_set
from .simjoin import greedy_leaders, jaccard, similar_pairs

#: Bits of a filter: 8 MiB whatever it is made of.
FILTER_BITS = 1 << 26


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)) + 1


def split_by(table: DataFrame, key: Column, keys: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` may be among ``keys``, rows whose ``key`` is not): no row of ``table`` is shuffled."""
    pages = keys.groupBy(F.bitmap_bucket_number(_slot(F.col(col))).alias("_page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(_slot(F.col(col)))).alias("_bits"))
    row = table.select(F.struct("*").alias("row"), _slot(key).alias("_s"), key.isNotNull().alias("_named"))
    judged = row.withColumn("_page", F.bitmap_bucket_number("_s")).join(F.broadcast(pages), "_page", "left")
    at = F.bitmap_bit_position("_s")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.col("_named") & (F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1), F.lit(False))
    judged = judged.withColumn("_hit", hit)
    return judged.where("_hit").select("row.*"), judged.where("not _hit").select("row.*")


def _rows(df: DataFrame, order: str) -> DataFrame:
    bucket = F.coalesce(F.lower("language"), F.lit(""))
    return df.select(F.col(order).alias("ord"), normalize_doi(F.col("doi")).alias("d"), F.array_sort(title_tokens(F.col("title"))).alias("tokens"), bucket.alias("bucket"))


def _prefixes(sets: DataFrame, rarity: DataFrame, threshold: float) -> DataFrame:
    """(node, bucket, n, token, tokens): the tokens in front, by the index's order, that a similar set shares one of."""
    words = sets.select("node", F.explode("tokens").alias("token"))
    known, _ = split_by(rarity, F.col("token"), words.select("token").distinct(), "token")
    ranked = words.join(known, "token", "left").groupBy("node").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token"))).alias("by_df"))
    front = (F.size("tokens") - F.ceil(F.size("tokens") * threshold - 1e-9) + 1).cast("int")
    rows = sets.join(ranked, "node").select("node", "bucket", "tokens", F.explode(F.slice("by_df", F.lit(1), front)).alias("x"))
    return rows.select("node", "bucket", F.size("tokens").alias("n"), F.col("x.token").alias("token"), "tokens")


class ResolutionIndex:
    """An index in ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, order: str = "ord", threshold: float = 0.85, min_tokens: int = 6):
        self.spark, self.path, self.order, self.threshold, self.min_tokens = spark, path.rstrip("/"), order, threshold, min_tokens

    def _table(self, name: str, before: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}").where(F.col("batch") < before).drop("batch")

    def _write(self, df: DataFrame, name: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch}")

    def _add(self, rows: DataFrame, led: DataFrame, batch: int) -> None:
        """Write what ``rows``, with their leaders, add to the index; the DOIs last, so a batch that is there is whole."""
        rows = saved(rows.join(led, "ord"), "index-rows")
        leaders = rows.where(f"ord = leader and size(tokens) >= {self.min_tokens}").select(F.col("ord").alias("node"), "bucket", "tokens")
        if batch == 0:
            counts = leaders.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
            counts.write.mode("overwrite").parquet(f"{self.path}/rarity")
        self._write(_prefixes(leaders, self.spark.read.parquet(f"{self.path}/rarity"), self.threshold), "titles", batch)
        self._write(rows.agg(F.max("ord").alias("last")), "ends", batch)
        self._write(rows.where("d is not null").groupBy("d").agg(F.min("leader").alias("leader")), "dois", batch)

    def build(self, df: DataFrame) -> DataFrame:
        """Index ``df``, batch 0, by resolving it once; (ord, leader)."""
        led = saved(cluster_leaders(df, self.order, self.threshold, self.min_tokens), "index-leaders")
        self._add(_rows(df, self.order), led, 0)
        return led

    def probe(self, new: DataFrame, batch: int) -> DataFrame:
        """(ord, leader) of the rows of batch ``batch``, which are added to the index."""
        if not exists(self.spark, f"{self.path}/dois/batch=0"):
            raise ValueError(f"no index at {self.path}")
        rows = saved(_rows(new, self.order), "probe-rows")
        last, first = self._table("ends", batch).agg(F.max("last")).first()[0], rows.agg(F.min("ord")).first()[0]
        if first is not None and last is not None and first <= last:
            raise ValueError(f"row {first} does not come after row {last} of the index")
        # Rows whose DOI the index knows, and the first row of every other.
        asked = rows.where("d is not null").groupBy("d").agg(F.min("ord").alias("doi_first"))
        dois, _ = split_by(self._table("dois", batch), F.col("d"), asked, "d")
        asked = saved(asked.join(dois.withColumnRenamed("leader", "known"), "d", "left"), "probe-dois")
        rows = rows.where("d is not null").join(asked, "d").unionByName(rows.where("d is null").withColumn("doi_first", F.col("ord")), allowMissingColumns=True)
        rows = saved(rows, "probe-keyed")
        lead = rows.where(f"known is null and ord = doi_first and size(tokens) >= {self.min_tokens}")
        classes = saved(lead.groupBy("bucket", "tokens").agg(F.min("ord").alias("node")), "probe-titles")
        # Leaders of the index come before all new rows, so the earliest similar one is a class's leader.
        fronts = saved(_prefixes(classes, self.spark.read.parquet(f"{self.path}/rarity"), self.threshold), "probe-fronts")
        held, _ = split_by(self._table("titles", batch), F.concat_ws("\t", "bucket", "token"), fronts.select(F.concat_ws("\t", "bucket", "token").alias("k")), "k")
        held = held.select(F.col("node").alias("old"), "bucket", "token", F.col("n").alias("n_old"), F.col("tokens").alias("tokens_old"))
        fits = F.least("n", "n_old") >= F.greatest("n", "n_old") * self.threshold - 1e-9
        near = fronts.join(held, ["bucket", "token"]).where(fits & (jaccard(F.col("tokens"), F.col("tokens_old")) >= self.threshold))
        old = saved(near.groupBy("node").agg(F.min("old").alias("old")), "probe-old")
        fresh = saved(classes.join(old, "node", "left_anti"), "probe-fresh")
        led = greedy_leaders(similar_pairs(fresh.select("node", "bucket", "tokens"), None, self.threshold)).unionByName(old.withColumnRenamed("old", "leader"))
        titles = lead.select("ord", "bucket", "tokens").join(classes, ["bucket", "tokens"]).join(led, "node", "left")
        titles = titles.select(F.col("ord").alias("doi_first"), F.coalesce("leader", "node").alias("title_leader"))
        out = rows.join(titles, "doi_first", "left").select("ord", F.coalesce("known", "title_leader", "doi_first").alias("leader"))
        out = saved(out, "probe-leaders")
        self._add(rows.select("ord", "d", "tokens", "bucket"), out, batch)
        return out

    def merge(self, main: DataFrame, new: DataFrame, batch: int) -> DataFrame:
        """``main`` (the resolved rows of the index) with ``new``: rows that new ones join are completed, new leaders added."""
        order = self.order
        new = saved(new, "merge-new")
        led = self.probe(new, batch).withColumnRenamed("ord", "_o")
        facts = new.select(F.col(order).alias("_o"), source_set(new).alias("s"), F.when(good_authors(F.col("authors")), F.col("authors")).alias("g"))
        facts = facts.join(led, "_o").groupBy(F.col("leader").alias("_leader")).agg(
            F.array_distinct(F.flatten(F.collect_set("s"))).alias("_s"), F.min_by("g", F.when(F.col("g").isNotNull(), F.col("_o"))).alias("_g"), F.min("_o").alias("_first")
        )
        facts = saved(facts, "merge-facts")
        sources = lambda own: F.array_join(F.array_sort(F.array_union(own, "_s")), "|")
        authors = F.when(good_authors(F.col("authors")), F.col("authors")).otherwise(F.coalesce("_g", "authors"))

        def completed(rows: DataFrame) -> DataFrame:
            out = rows.join(facts, F.col(order) == F.col("_leader")).withColumn("_own", source_set(rows))
            out = out.drop("source_databases", "source_database").withColumn("source_databases", sources(F.col("_own"))).withColumn("authors", authors)
            return out.drop("_own", "_s", "_g", "_first", "_leader")

        touched, rest = split_by(main, F.col(order), facts, "_leader")
        plain = rest.unionByName(touched.join(facts.select("_leader"), F.col(order) == F.col("_leader"), "left_anti"))
        return plain.unionByName(completed(touched), allowMissingColumns=True).unionByName(completed(new), allowMissingColumns=True)


def resolve_in_batches(batches: list[DataFrame], path: str, order: str = "ord") -> DataFrame:
    """The resolution of all ``batches`` together, each in turn against the index in ``path``."""
    index = ResolutionIndex(batches[0].sparkSession, path, order)
    index.build(batches[0])
    main = saved(resolve(batches[0], order), "merged-0")
    for i, new in enumerate(batches[1:], 1):
        main = saved(index.merge(main, new, i), f"merged-{i}")
    return main
