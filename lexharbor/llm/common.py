"""Shared storage, bounded filters and distributed ranks for the training-data operators.

Everything an operator materialises goes below ``spark.checkpoint.dir`` (the folder all
executors share), as committed Parquet, so a lost executor only costs recomputation of
tasks, never of finished steps.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of every contract in this package: space and \t..\r.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows and bytes of an Arrow batch; whole texts are shipped, so batches are kept short.
ARROW_ROWS, ARROW_BYTES = 512, "8m"


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a private one is set only on a local master without any."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = held.get() if held.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="lexharbor-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


#: Paths written inside each open ``scratch_scope``.
_scopes: list[list[str]] = []


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_root(spark)}/{tag}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what operators wrote inside: put it around an action that needs their results no more."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove_path(spark, path)


def settle(df: DataFrame, tag: str, tidy: bool = True) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives executors.

    ``tidy``: then let the driver's collector free plans, broadcasts and shuffles of the steps before.
    """
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch = path
    if tidy:
        spark._jvm.System.gc()
    return back


def discard(*settled: DataFrame) -> None:
    """Delete settled tables of which nothing that is still to be computed reads, and shuffles of finished steps.

    Spark deletes the files of a shuffle when the driver's collector finds its plan unreachable, which
    may be long after the table that the shuffle served is written.
    """
    for df in settled:
        remove_path(df.sparkSession, df._scratch)
    settled[0].sparkSession._jvm.System.gc()


#: Characters of a plan's description; the driver keeps those of its last 1000 executions.
PLAN_CHARS = "8k"


def tune(spark: SparkSession) -> None:
    """Short Arrow batches, as rows carry whole texts, and short descriptions, as plans are long and many."""
    spark.conf.set("spark.sql.maxPlanStringLength", PLAN_CHARS)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def squeezed(text: Column) -> Column:
    """Null as empty, each white-space run as one space (single spaces are left untouched)."""
    return F.regexp_replace(
        F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " "
    )


# ---------------------------------------------------------------- bounded membership filters
#: Bits of a filter that is broadcast: 2048 pages of 4 KiB, 8 MiB whatever the input is.
FILTER_BITS = 1 << 26


def filter_bits(n: int) -> int:
    """Bits of a filter of ``n`` keys: 32 for each at least, and FILTER_BITS at most."""
    return min(FILTER_BITS, 1 << max(15, (32 * n - 1).bit_length()))


def bit_slot(key: Column, bits: int) -> Column:
    """1-based slot of ``key`` among ``bits``."""
    return F.pmod(F.xxhash64(key), F.lit(bits)) + F.lit(1)


def bit_is_set(bitmap: Column, slot: Column) -> Column:
    """Whether the page ``bitmap`` (null: empty page) has the bit of ``slot``."""
    pos = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(pos / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.floor(byte / F.pow(F.lit(2), pos % 8)) % 2 == 1, F.lit(False))


def filter_pages(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """(page, bitmap) rows of a one-hash filter over ``keys[key]``; at most bits/32768 rows."""
    slot = bit_slot(F.col(key), bits)
    return keys.groupBy(F.bitmap_bucket_number(slot).alias("_page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits")
    )


def with_membership(df: DataFrame, key: str, keys: DataFrame, keys_col: str, out: str, bits: int = FILTER_BITS) -> DataFrame:
    """Add ``out``: false proves that ``df[key]`` is not among ``keys``.

    The filter has a fixed number of bits, so its broadcast is bounded by ``bits / 8`` bytes; when
    keys are so many that it saturates, it only stops saving work, results stay the same.
    """
    pages = F.broadcast(filter_pages(keys, keys_col, bits))
    slot = bit_slot(F.col(key), bits)
    return (
        df.withColumn("_slot", slot)
        .withColumn("_page", F.bitmap_bucket_number(F.col("_slot")))
        .join(pages, "_page", "left")
        .withColumn(out, bit_is_set(F.col("_bits"), F.col("_slot")))
        .drop("_slot", "_page", "_bits")
    )


def without(rows: DataFrame, key: str, gone: DataFrame, gone_col: str) -> DataFrame:
    """``rows`` whose ``key`` is not among ``gone``; only rows that may be gone are shuffled."""
    gone = settle(gone.select(F.col(gone_col).alias("_gone")).distinct(), "gone")
    judged = with_membership(rows, key, gone, "_gone", "_maybe", filter_bits(gone.count()))
    rest = judged.where("_maybe").join(gone, F.col(key) == F.col("_gone"), "left_anti")
    return judged.where("not _maybe").unionByName(rest).select(*rows.columns)


# ---------------------------------------------------------------- joins with hot keys
#: Rows of one key that one task may get whatever the input is, and keys that may be dealt over tasks.
SHARE_ROWS, HOT_KEYS = 256, 1 << 16


def share_limit(total: int) -> int:
    """Rows beyond which a key is dealt over shares; fewer than HOT_KEYS keys can have more."""
    return max(SHARE_ROWS, total // HOT_KEYS)


def with_shares(rows: DataFrame, sizes: DataFrame, key: str, count: str, salt: str | Column, total: int) -> DataFrame:
    """Add ``_share``: rows of a hot key are dealt by ``salt`` over shares of SHARE_ROWS, all others are share 0.

    ``sizes`` has one row for each key, with its ``count``.  Only hot keys are broadcast.
    """
    hot = sizes.where(F.col(count) > share_limit(total)).select(F.col(key).alias("_hot"), F.ceil(F.col(count) / SHARE_ROWS).alias("_shares"))
    dealt = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    return dealt.withColumn("_share", F.coalesce(F.pmod(F.xxhash64(salt), F.col("_shares")), F.lit(0).cast("long"))).drop("_hot", "_shares")


def for_shares(table: DataFrame, count: str, total: int) -> DataFrame:
    """``table`` with a row for each ``_share`` that ``with_shares`` gives its key."""
    shares = F.when(F.col(count) > share_limit(total), F.ceil(F.col(count) / SHARE_ROWS)).otherwise(1)
    return table.withColumn("_share", F.explode(F.sequence(F.lit(0).cast("long"), shares.cast("long") - 1)))


def spread_join(rows: DataFrame, table: DataFrame, key: str, count: str, salt: str | Column, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table`` (one row for each ``key``, with its ``count`` in ``rows``); hot keys are spread."""
    dealt = with_shares(rows, table, key, count, salt, total)
    return dealt.join(for_shares(table, count, total), [key, "_share"], how).drop("_share")


def joined_spread(rows: DataFrame, table: DataFrame, key: str, salt: str | Column, how: str = "inner", counted: DataFrame | None = None) -> DataFrame:
    """``rows`` joined with ``table`` (one row for each ``key``); keys that are hot in ``rows`` are spread.

    Rows are counted first (``counted``: a table with the same keys as often), so give settled ones.
    """
    counted = rows if counted is None else counted
    sizes = counted.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > SHARE_ROWS)
    if sizes.isEmpty():
        return rows.join(table, key, how)
    total = counted.count()
    hot = settle(sizes.where(F.col("_rows") > share_limit(total)), "hot")
    dealt = with_shares(rows, hot, key, "_rows", salt, total)
    held = for_shares(table.join(F.broadcast(hot), key, "left"), "_rows", total).drop("_rows")  # fewer than HOT_KEYS keys
    return dealt.join(held, [key, "_share"], how).drop("_share")


# ---------------------------------------------------------------- global ranks without one task
def dense_index(df: DataFrame, order: list, tag: str, out: str = "idx") -> DataFrame:
    """``df`` with ``out`` = 0,1,2,... in the given order, written to the shared folder.

    Rows are range-partitioned (equal keys stay in one range, so ``order`` ends with columns that
    tell rows apart), each partition numbers its rows, and only one count per partition reaches the
    driver.
    """
    spark = df.sparkSession
    path = scratch(spark, tag)
    df = settle(df, f"{tag}-input")  # sampling the ranges would compute the input a second time
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_m", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    discard(df)
    back = spark.read.parquet(path)
    part = F.shiftright(F.col("_m"), 33)
    counts = sorted((r[0], r[1]) for r in back.groupBy(part.alias("p")).count().collect())
    starts, total = [], 0
    for p, n in counts:
        starts.append((p, total))
        total += n
    base = spark.createDataFrame(starts or [(-1, 0)], "_p long, _start long")
    return (
        back.withColumn("_p", part)
        .join(F.broadcast(base), "_p")
        .withColumn(out, F.col("_start") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_p", "_m", "_start")
    )
