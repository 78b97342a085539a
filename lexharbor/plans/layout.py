"""A results layout: files against ordered glob rules, relationally, and their moves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators._storage import exists
from ..sources.moves import finish, move_all, names

# Glob and target folder, first match wins.
RULES = [
    ("*.log", "logs"), ("raw_archive*.parquet", "archive"), ("*.bak", "archive"), ("*.bak.*", "archive"), ("pilot*_labeled*.csv", "pilots"), ("pilot*.csv", "pilots"),
    ("gap_matrix_*.csv", "analysis"), ("cross_project_*.csv", "analysis"), ("coverage_matrix_*.csv", "analysis"), ("knn_anchor_*.csv", "analysis"),
    ("*_reading_list.csv", "analysis"), ("*.png", "analysis"), ("*.pdf", "analysis"),
]
_GAP = r"^([a-z][a-z0-9_]*_gap)(?:_(.+))?\.csv$"


def plan_moves(files: DataFrame) -> DataFrame:
    """(name, target) of the files that move; raises where two files have one target."""
    name = F.col("name")
    backup = name.endswith(".bak") | F.contains(name, F.lit(".bak."))
    canonical = ~backup & (F.contains(name, F.lit("_bibliography")) | F.contains(name, F.lit("_labeled_corpus")) | name.endswith(".embeddings.npy") | name.endswith(".embeddings.ids.txt"))
    stage = F.coalesce(F.nullif(F.regexp_extract(name, _GAP, 2), F.lit("")), F.lit("records"))
    target = F.when(name.rlike(_GAP), F.concat(F.lit("gapfills/"), F.regexp_extract(name, _GAP, 1), F.lit("/"), stage, F.lit(".csv")))
    for glob, folder in RULES:
        pattern = "^" + glob.replace(".", r"\.").replace("*", ".*") + "$"
        target = target.when(name.rlike(pattern), F.concat(F.lit(f"{folder}/"), name))
    moves = files.where(~canonical).select("name", target.alias("target")).where("target is not null")
    twice = moves.groupBy("target").count().where("count > 1")
    if not twice.isEmpty():
        raise ValueError("two files have one target: " + ", ".join(r["target"] for r in twice.limit(5).collect()))
    return moves


def apply_moves(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """Move the files of ``folder`` by plan, all or none: (name, target) in order of name.

    Nothing moves if two files have one target or a target is there.  Moves that a stopped driver
    left open are carried out first.
    """
    folder = folder.rstrip("/")
    finish(spark, folder)
    files = spark.createDataFrame([(n,) for n in names(spark, folder, files=True)], "name string")
    moves = sorted(tuple(r) for r in plan_moves(files).collect())  # names in one folder, which its listing holds too
    if there := [target for _, target in moves if exists(spark, f"{folder}/{target}")]:
        raise ValueError("targets are there already: " + ", ".join(there[:5]))
    if moves:
        move_all(spark, folder, [(f"{folder}/{name}", f"{folder}/{target}") for name, target in moves])
    return moves
