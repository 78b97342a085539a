"""Merging, comparing and completing corpora."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import candidate_keys, normalize_doi, title_tokens
from ._storage import saved
from .filters import anti_join, missing_text
from .matching import greedy_matches
from .reports import check_source_coverage
from .resolve import resolve
from .simjoin import similar_pairs


def union_by_name(main: DataFrame, more: DataFrame) -> DataFrame:
    """Rows of both; the main table's columns come first, missing ones are null."""
    out = main.unionByName(more, allowMissingColumns=True)
    return out.select(*main.columns, *[c for c in out.columns if c not in main.columns])


def gap_fill_merge(main: DataFrame, gap: DataFrame, order: str = "ord") -> DataFrame:
    """Main then gap rows, resolved; raises where provenance collapsed.  ``order`` is unique over both."""
    merged = saved(resolve(union_by_name(main, gap), order), "merged")
    if message := check_source_coverage(main, merged):
        raise ValueError(message)
    return merged


def novelty(new: DataFrame, corpus: DataFrame) -> DataFrame:
    """Add novelty: no_doi, in_corpus or new."""
    known = corpus.select(normalize_doi(F.col("doi")).alias("_k")).where("_k is not null").distinct()
    d = normalize_doi(F.col("doi"))
    with_doi = new.where(d.isNotNull()).join(known, d == F.col("_k"), "left")
    with_doi = with_doi.withColumn("novelty", F.when(F.col("_k").isNotNull(), "in_corpus").otherwise("new")).drop("_k")
    return with_doi.unionByName(new.where(d.isNull()).withColumn("novelty", F.lit("no_doi")))


def net_new(main: DataFrame, merged: DataFrame) -> DataFrame:
    """One row (before, after, net_new): rows that a merge adds."""
    before = main.agg(F.count(F.lit(1)).alias("before"))
    return before.crossJoin(merged.agg(F.count(F.lit(1)).alias("after"))).withColumn("net_new", F.col("after") - F.col("before"))  # one row each


def novelty_counts(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("novelty").agg(F.count(F.lit(1)).alias("n"), F.count_if(missing_text(F.col("abstract"))).alias("n_no_abstract"))


def recover_sources(df: DataFrame, notes: DataFrame) -> DataFrame:
    """Fill empty source_databases from (doi, note), by normalised DOI; the last note of a DOI wins upstream."""
    known = notes.select(normalize_doi(F.col("doi")).alias("_d"), F.col("note").alias("_note")).where("_d is not null and _note <> ''").dropDuplicates(["_d"])
    own = normalize_doi(F.col("doi"))
    out = df.where(own.isNotNull()).join(known, own == F.col("_d"), "left").unionByName(df.where(own.isNull()), allowMissingColumns=True)
    return out.withColumn("source_databases", F.coalesce(F.nullif("source_databases", F.lit("")), "_note", F.lit(""))).drop("_d", "_note")


def fill_from_cache(df: DataFrame, cache: DataFrame, col: str = "abstract") -> DataFrame:
    """Fill missing texts from (key, text): the first of a row's candidate keys that the cache has."""
    todo = df.where(missing_text(F.col(col))).select("id", F.posexplode(candidate_keys(F.col("id"), F.col("doi"))).alias("pos", "key"))
    best = todo.join(cache.select("key", F.col("text").alias("_t")).where("_t is not null"), "key").groupBy("id").agg(F.min_by("_t", "pos").alias("_t"))
    return df.join(best, "id", "left").withColumn(col, F.when(missing_text(F.col(col)), F.col("_t")).otherwise(F.col(col))).drop("_t")


def waterfall(df: DataFrame, sources: Sequence[tuple[str, DataFrame, int]], order: str = "ord", col: str = "abstract") -> DataFrame:
    """Fill missing texts by DOI, source after source; each gets its cap of rows still missing, in order.

    ``sources``: (name, (doi, text) table, cap).  Adds ``filled_by``.  Only places and DOIs of rows
    without a text go from pass to pass; texts are joined to the table once.
    """
    open_ = saved(df.where(missing_text(F.col(col)) & normalize_doi(F.col("doi")).isNotNull()).select(F.col(order).alias("_o"), normalize_doi(F.col("doi")).alias("_k")), "waterfall")
    filled = None
    for name, table, cap in sources:
        asked = open_.orderBy("_o").limit(cap)
        known = table.select(normalize_doi(F.col("doi")).alias("_k"), F.col("text").alias("_t")).where("_k is not null").dropDuplicates(["_k"])
        got = saved(asked.join(known, "_k").where(~missing_text(F.col("_t"))).select("_o", "_t", F.lit(name).alias("filled_by")), f"waterfall-{name}")
        filled = got if filled is None else filled.unionByName(got)
        open_ = open_.join(got.select("_o"), "_o", "left_anti")
    if filled is None:
        return df.withColumn("filled_by", F.lit(None).cast("string"))
    out = df.join(filled, F.col(order) == F.col("_o"), "left")
    return out.withColumn(col, F.coalesce("_t", col)).drop("_o", "_t")


def coverage_by_pass(filled: DataFrame, sources: Sequence[str], col: str = "abstract") -> DataFrame:
    """(pass, filled, covered, percent): texts after each pass of a waterfall, ``start`` first, in order."""
    had = F.count_if(~missing_text(F.col(col)) & F.col("filled_by").isNull())
    counts = filled.agg(F.count(F.lit(1)).alias("_n"), had.alias("_0"), *[F.count_if(F.col("filled_by") == s).alias(f"_{i}") for i, s in enumerate(sources, 1)])
    row = lambda i, name: F.struct(F.lit(i).alias("step"), F.lit(name).alias("pass"), F.col(f"_{i}").alias("filled"), sum((F.col(f"_{k}") for k in range(1, i + 1)), F.col("_0")).alias("covered"))
    rows = counts.select("_n", F.inline(F.array(*[row(i, s) for i, s in enumerate(["start", *sources])])))
    return rows.select("step", "pass", "filled", "covered", (100.0 * F.col("covered") / F.greatest("_n", F.lit(1))).alias("percent"))


def title_matches(left: DataFrame, right: DataFrame, threshold: float = 0.85, order: str = "ord") -> DataFrame:
    """(a, b): one-to-one greedy matches by title.  Rows with a DOI are matched before rows without.

    Candidates come from the prefix-filter join of distinct token sets, so equal titles are never
    paired row by row; the greedy order is kept over pairs of sets (``matching``).
    """
    def rows(df):
        sets = df.select(F.col(order).alias("o"), normalize_doi(F.col("doi")).isNull().alias("late"), F.array_sort(title_tokens(F.col("title"))).alias("tokens")).where("size(tokens) > 0")
        sets = saved(sets, "title-rows")
        classes = saved(sets.groupBy("tokens").agg(F.min("o").alias("node")).withColumn("bucket", F.lit("")), "title-classes")
        return sets.join(classes, "tokens").select("o", "late", "node"), classes

    (own, own_classes), (other, other_classes) = rows(left), rows(right)
    pairs = saved(similar_pairs(own_classes.select("node", "bucket", "tokens"), other_classes.select("node", "bucket", "tokens"), threshold), "title-pairs")
    pairs = pairs.select("a", "b", F.col("similarity").alias("s"))
    return greedy_matches(pairs, own.withColumnRenamed("node", "c"), other.withColumnRenamed("node", "c"))


def compare_corpora(left: DataFrame, right: DataFrame, threshold: float = 0.85, order: str = "ord") -> DataFrame:
    """(side, ord, status): overlap by DOI, overlap by title, or only on this side."""
    keyed = [saved(df.withColumn("_d", normalize_doi(F.col("doi"))), "compare") for df in (left, right)]
    both = keyed[0].select("_d").where("_d is not null").distinct().intersect(keyed[1].select("_d").where("_d is not null").distinct())
    both = saved(both, "compare-dois")
    rest = [anti_join(df, F.col("_d"), both.withColumnRenamed("_d", "_x"), "_x") for df in keyed]
    pairs = saved(title_matches(rest[0], rest[1], threshold, order), "compare-titles")
    out = None
    for side, df, col in (("left", keyed[0], "a"), ("right", keyed[1], "b")):
        hit = both.withColumn("_both", F.lit(True))
        # Rows without a DOI match none; joined on it they would all meet in one task.
        named = df.where("_d is not null").join(hit, "_d", "left").unionByName(df.where("_d is null"), allowMissingColumns=True)
        one = named.join(pairs.select(F.col(col).alias(order)).withColumn("_title", F.lit(True)), order, "left")
        status = F.when(F.col("_both"), "overlap_doi").when(F.col("_title"), "overlap_title").otherwise("only")
        one = one.select(F.lit(side).alias("side"), F.col(order).alias("ord"), status.alias("status"))
        out = one if out is None else out.unionByName(one)
    return out
