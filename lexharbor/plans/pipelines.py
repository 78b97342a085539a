"""The composite pipelines, from harvest to report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..backends.embed import embed_column
from ..backends.label import label_column
from ..functions import text as T
from ..operators import citations, filters, labels, merge, reports, resolve, vectors
from ..operators._storage import saved
from ..schema import CSV_COLUMNS
from ..sources import files, lookup, normalize
from ..streaming.ingest import append_missing


def harvest(raw: DataFrame, sources: Sequence[str], vocab: Mapping, block: Sequence[str] = (), exclude: DataFrame | None = None) -> DataFrame:
    """Raw responses to a ranked bibliography: filter, resolve, exclude (after resolving), augment, rank."""
    rec = saved(filters.spec_filter(normalize.harvest(raw, list(sources)), block), "harvest")
    done = resolve.resolve(rec)
    if exclude is not None:
        done = filters.exclude_dois(done, exclude)
    done = filters.augment(done, vocab)
    return filters.ranked(filters.available(done, CSV_COLUMNS + [f"{a}_mentioned" for a in vocab] + ["ord"]))


def embed_and_score(df: DataFrame, anchors: DataFrame, cache: DataFrame | None = None, backend: str = "hashing", **options) -> DataFrame:
    """Vectors for rows the cache lacks, then the best anchor of each row; ``anchors``: anchor_idx, text."""
    rows = df.withColumn("_text", T.row_text(F.col("title"), F.col("abstract_snippet") if "abstract_snippet" in df.columns else F.lit(None), F.col("abstract")))
    todo = rows.where("length(_text) > 0")
    fresh = embed_column(filters.pending(todo, cache) if cache is not None else todo, "id", "_text", backend, **options)
    known = saved(fresh if cache is None else fresh.unionByName(cache.select("id", "embedding")), "vectors")
    marks = embed_column(anchors, "anchor_idx", "text", backend, **options)
    return vectors.score_anchors(df.join(known, "id", "left"), marks).drop("embedding")


def update_vector_cache(df: DataFrame, path: str, part: int, backend: str = "hashing", **options) -> DataFrame:
    """The cache at ``path`` with vectors for all rows that have a text; ``part`` numbers this run's rows."""
    rows = df.withColumn("_text", T.row_text(F.col("title"), F.col("abstract_snippet") if "abstract_snippet" in df.columns else F.lit(None), F.col("abstract")))
    append_missing(rows.where("length(_text) > 0").select("id", "_text"), path, "id", lambda todo: embed_column(todo, "id", "_text", backend, **options), part)
    return df.sparkSession.read.parquet(path)


def diagnose(df: DataFrame, anchors: DataFrame, min_score: float = 0.45, k: int = 3, order: str = "ord") -> str:
    return reports.markdown_report(df, anchors, min_score, k, order=order)


def label(df: DataFrame, low: float = 0.45, high: float | None = None, limit: int | None = None, log: DataFrame | None = None, gate: str | None = None, system_prompt: str = "", backend: str = "rules", order: str = "ord", **options) -> DataFrame:
    """Labels for rows in the score band that the log lacks, joined to all rows."""
    rows = filters.score_band(df, low, high) if "embed_score" in df.columns else df
    rows = labels.gated(rows, gate) if gate else rows
    rows = rows.orderBy(order).limit(limit) if limit is not None else rows
    todo = filters.pending(rows, log) if log is not None else rows
    tags = F.col("minerals_mentioned") if "minerals_mentioned" in df.columns else F.lit(None).cast("string")
    short = F.col("abstract_snippet") if "abstract_snippet" in df.columns else F.lit(None).cast("string")
    asked = todo.select("id", T.label_prompt(F.col("title"), F.col("language"), tags, F.col("abstract"), short).alias("prompt"))
    got = saved(labels.with_labels(label_column(asked, "id", "prompt", system_prompt, backend, **options), "reply", "error").drop("reply", "error"), "labels")
    if log is not None:
        got = got.unionByName(labels.last_checkpoint(log).drop("chunk"), allowMissingColumns=True)
    return labels.join_labels(df, got)


def backfill(df: DataFrame, raw: DataFrame, lookups: Sequence[tuple[str, DataFrame, int]], uid_table: DataFrame | None = None, order: str = "ord") -> DataFrame:
    """Cache, then lookups by DOI, then by identifier; each only for rows still without an abstract."""
    df = merge.fill_from_cache(df, files.cached_abstracts(raw))
    df = merge.waterfall(df, lookups, order)
    if uid_table is not None:
        own = uid_table.select(F.col("key").alias("id"), F.col("text").alias("_t")).dropDuplicates(["id"])
        df = df.join(own, "id", "left").withColumn("abstract", F.when(filters.missing_text(F.col("abstract")) & F.col("id").startswith("WOS:"), F.col("_t")).otherwise(F.col("abstract"))).drop("_t")
    return df.withColumn("abstract_snippet", T.snippet(F.col("abstract")))


def online_lookups(df: DataFrame, order: str = "ord") -> list[tuple[str, DataFrame, int]]:
    """Lookup tables for ``backfill`` that ask the services, in order, for rows without an abstract."""
    missing = df.where(filters.missing_text(F.col("abstract"))).withColumn("_key", T.normalize_doi(F.col("doi"))).where("_key is not null").orderBy(order)
    return [(name, lookup.lookup_table(missing.limit(cap), "_key", fetch).withColumnRenamed("key", "doi"), cap) for name, fetch, cap in lookup.ABSTRACT_LOOKUPS]


def chase(corpus: DataFrame, works: DataFrame, edges: DataFrame, vocab: Mapping, top: int = 20, cap: int = 500, block: Sequence[str] = ()) -> DataFrame:
    """Works one citation away from the best core records, filtered, resolved, augmented; only new ones."""
    seeds = saved(citations.seeds_from_labels(corpus, top).select("id"), "seeds")
    ids = citations.forward(edges, seeds, cap).unionByName(citations.backward(edges, seeds)).distinct()
    found = saved(filters.spec_filter(works.join(ids, "id", "left_semi"), block), "chased")
    fresh = filters.augment(resolve.resolve(found), vocab).withColumn("source_databases", F.lit("citation_chase"))
    return filters.not_present(fresh, corpus)


def append_ranked(corpus: DataFrame, fresh: DataFrame) -> DataFrame:
    """Corpus and new rows by priority, nulls last."""
    return merge.union_by_name(corpus, fresh).orderBy(F.col("priority_score").desc_nulls_last(), "id")


def add_queries(corpus: DataFrame, raw: DataFrame, queries: Sequence[str], vocab: Mapping, source: str = "openalex", block: Sequence[str] = ()) -> DataFrame:
    """New records of some queries of one source, appended; unknown queries raise."""
    known = {r[0] for r in raw.where(F.col("source") == source).select("query").distinct().collect()}
    if unknown := [q for q in queries if q not in known]:
        raise ValueError(f"no raw responses for {unknown}")
    rec = saved(filters.spec_filter(normalize.harvest(raw.where(F.col("query").isin(*queries)), [source]), block), "added")
    return append_ranked(corpus, filters.not_present(filters.augment(resolve.resolve(rec), vocab), corpus))


def screen_export(spark: SparkSession, path: str, vocab: Mapping, axis: str, only: str, block: Sequence[str] = ()) -> DataFrame:
    """A tagged export in the record schema, with its relevance bucket and rank."""
    rec = filters.spec_filter(files.tagged_to_records(files.tagged_records(spark, path)), block)
    rec = rec.withColumn("relevance", filters.relevance(F.col("title"), F.col("abstract"), vocab[axis], only, block))
    return filters.ranked(filters.augment(rec, vocab))


def gap_novelty(found: DataFrame, corpus: DataFrame, vocab: Mapping, order: str = "ord") -> DataFrame:
    """Distinct found records with their novelty against the corpus, augmented."""
    return filters.augment(merge.novelty(resolve.first_by(found, "id", order), corpus), vocab)


def recover_sources(spark: SparkSession, df: DataFrame, bib: str) -> DataFrame:
    return merge.recover_sources(df, files.bib_notes(spark, bib))


def comparison_tables(left: DataFrame, right: DataFrame, threshold: float = 0.85, order: str = "ord") -> dict[str, DataFrame]:
    """The rows of overlap (both sides'), left_only and right_only."""
    status = saved(merge.compare_corpora(left, right, threshold, order), "comparison")
    side = lambda name, df, kind: df.join(status.where((F.col("side") == name) & kind).select(F.col("ord").alias(order)), order, "left_semi")
    only = F.col("status") == "only"
    both = merge.union_by_name(side("left", left, ~only), side("right", right, ~only))
    return {"overlap": both, "left_only": side("left", left, only), "right_only": side("right", right, only)}
