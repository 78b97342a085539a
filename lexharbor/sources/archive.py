"""Sinks: verified raw archive, single-file CSV, text and label logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import raw_file_name
from ..operators._storage import delete, exists, saved, scratch
from .committed import write_named
from .moves import swap


def content_digest(raw: DataFrame) -> tuple[int, int]:
    """(rows, sum of the heads of the rows' md5): equal for tables with the same rows, in any order."""
    cells = [F.coalesce(F.concat(F.lit("1"), F.col(c).cast("string")), F.lit("0")) for c in raw.columns]
    head = F.conv(F.substring(F.md5(F.to_json(F.array(*cells))), 1, 12), 16, 10).cast("decimal(38,0)")
    n, total = raw.agg(F.count(F.lit(1)), F.sum(head)).first()
    return n, int(total or 0)


def archive_verified(raw: DataFrame, path: str | None = None, level: int = 9, remove: str | None = None) -> DataFrame:
    """Write (source, query, payload_json) as zstd Parquet; raises unless all rows read back as they were.

    ``remove``: the folder of the raw files; it is deleted once the archive is verified, never before.
    """
    raw, spark = saved(raw, "raw"), raw.sparkSession
    target = path or scratch(spark, "archive")
    raw.write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level)).parquet(target)
    back = spark.read.schema(raw.schema).parquet(target)
    if content_digest(back) != content_digest(raw):
        raise OSError("the archive differs from its input; the input is kept")
    if remove is not None:
        delete(spark, remove)
    return back


def rewrite(df: DataFrame, path: str, write) -> str | None:
    """``write(df, path)``, keeping what is there under the next free ``.bak`` name, which is returned; see ``moves.swap``."""
    return swap(df, path, write)


def write_csv(df: DataFrame, path: str, single: bool = True) -> None:
    """RFC quoting; one file where ``single`` (a deliverable, not an intermediate)."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_raw_files(raw: DataFrame, path: str) -> None:
    """One file for each row of (source, query, payload_json), named by source and query; all of them or none."""
    name = raw_file_name(F.col("source"), F.col("query"))
    write_named(raw.where("payload_json is not null").select(name.alias("name"), F.col("payload_json").alias("content")), path)


def read_csv(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def write_lines(df: DataFrame, col: str, path: str, order=None) -> None:
    """One value a line; sorted by range partitions where an order is given."""
    (df.orderBy(order) if order is not None else df).select(F.col(col).cast("string")).write.mode("overwrite").text(path)


def write_bibtex(df: DataFrame, path: str, order: str = "ord") -> None:
    """BibTeX entries in order, keys made unique."""
    from ..functions.bibtex import entry, with_keys

    keyed = with_keys(df, order)
    keyed.orderBy(order).select(entry(keyed, F.col("bib_key")).alias("value")).write.mode("overwrite").text(path)


def append_checkpoint(labels: DataFrame, path: str, chunk: int) -> None:
    labels.withColumn("chunk", F.lit(chunk)).write.mode("append").parquet(path)


def clear_checkpoints(spark, path: str, expected: DataFrame, key: str = "id") -> bool:
    """Delete the checkpoints at ``path`` if every key of ``expected`` has a row there; tells whether it did."""
    if not exists(spark, path):
        return False
    done = spark.read.parquet(path)
    if not expected.select(key).join(done.select(key), key, "left_anti").isEmpty():
        return False
    delete(spark, path)
    return True


def rejects(df: DataFrame, path: str) -> None:
    """The error log as a table."""
    df.write.mode("append").parquet(path)
