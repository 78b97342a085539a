"""Renames that happen together: a journal lists them, and a restart carries out what is left.

Works on any file system of Spark.  A journal counts once it has its name; until then nothing has moved.
A rename is done if its target is there or its source is not, so carrying a journal out again is harmless.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from ..operators._storage import delete, exists, saved

#: Names of journals and of tables that are not in their place yet; Spark's readers pass over both.
JOURNAL, NEW = "_moves-", "_new-"


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _rename(spark: SparkSession, source: str, target: str) -> None:
    store, a = _store(spark, source)
    b = spark._jvm.org.apache.hadoop.fs.Path(target)
    store.mkdirs(b.getParent())
    if not store.rename(a, b):
        raise OSError(f"{source} was not renamed to {target}")


def names(spark: SparkSession, folder: str, files: bool = False) -> list[str]:
    """Names in ``folder``, of files only if asked; none if it is not there."""
    store, where = _store(spark, folder)
    if not store.exists(where):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(where) if s.isFile() or not files)


def _carry_out(spark: SparkSession, journal: str) -> None:
    store, where = _store(spark, journal)
    stream = store.open(where)
    moves = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    for source, target in moves:
        if exists(spark, source) and not exists(spark, target):
            _rename(spark, source, target)
    delete(spark, journal)


def finish(spark: SparkSession, folder: str) -> int:
    """Carry out the journals that stopped drivers left in ``folder``; the number of them."""
    left = [n for n in names(spark, folder) if n.startswith(JOURNAL) and not n.endswith(".tmp")]
    for name in left:
        _carry_out(spark, f"{folder}/{name}")
    return len(left)


def move_all(spark: SparkSession, folder: str, moves: Iterable[tuple[str, str]]) -> None:
    """Rename all of (source, target), in order, under a journal in ``folder``."""
    journal = f"{folder}/{JOURNAL}{uuid.uuid4().hex}"
    store, draft = _store(spark, f"{journal}.tmp")
    out = store.create(draft)
    out.write(bytearray(json.dumps(list(moves)).encode()))
    out.close()
    _rename(spark, f"{journal}.tmp", journal)  # from here on the moves count
    _carry_out(spark, journal)


def swap(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> str | None:
    """``write(df, ...)`` beside ``path``, then rename: the old table to the next free ``.bak`` name, the new one to ``path``.

    Returns the old table's new path, or None if there was none.  ``df`` may read from ``path``.  A driver
    that stops leaves the old table, or a journal whose ``finish`` (which the next ``swap`` begins
    with) puts the new one in its place; a new table without a journal is deleted then.  One driver at a
    time rewrites a path.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    folder, _, base = path.rpartition("/")
    folder = folder or "."
    finish(spark, folder)
    fresh = f"{NEW}{base}-"
    for name in names(spark, folder):
        if name.startswith(fresh) and len(name) == len(fresh) + 32:
            delete(spark, f"{folder}/{name}")
    new, kept, moves = f"{folder}/{fresh}{uuid.uuid4().hex}", None, []
    write(saved(df, "swap"), new)
    if exists(spark, path):
        n = 0
        while exists(spark, kept := f"{path}.bak" + (f".{n}" if n else "")):
            n += 1
        moves.append((path, kept))
    move_all(spark, folder, [*moves, (new, path)])
    return kept
