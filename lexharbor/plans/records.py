"""Bibliographic views over the driver's tables, as DataFrames and as DuckDB text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record table: every document as one record."""
    d = table(spark, sf_dir, "documents")
    n, digest = F.col("doc_id"), F.md5("text")
    names = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.concat(F.lit("A"), i.cast("string"), F.lit(", X"))), "; ")
    pick = lambda c, *v: F.element_at(F.array(*[F.lit(x) for x in v]), (c + 1).cast("int"))
    two = F.concat(F.lit("Last"), (n % 50).cast("string"), F.lit(", F; Last"), (n % 7).cast("string"), F.lit(", G"))
    return d.select(
        F.col("doc_id").alias("ord"),
        F.concat(F.lit("doc:"), n.cast("string")).alias("id"),
        F.when(n % 3 == 1, F.concat(F.lit("https://doi.org/10.1/"), digest)).when(n % 3 == 2, F.concat(F.lit("DOI:10.1/"), F.upper(digest))).alias("doi"),
        F.substring_index("text", "\n", 1).alias("title"),
        (1990 + n % 35).cast("int").alias("publication_year"),
        F.when(n % 13 != 0, F.col("lang")).alias("language"),
        pick(n % 7, "article", "thesis", "Dissertation", "Editorial", None, "book-chapter", "letter").alias("type"),
        F.when(n % 11 != 0, F.col("text")).alias("abstract"),
        F.when(n % 19 == 0, "").when(n % 17 == 0, names).otherwise(two).alias("authors"),
        F.lit("Journal").alias("source_journal_or_publisher"),
        F.when(n % 5 != 0, (n % 40).cast("int")).alias("cited_by_count"),
        F.when(n % 2 != 0, F.concat(F.lit("https://x/"), n.cast("string"))).alias("open_access_url"),
        F.col("source").alias("source_database"),
    )


#: The same view for DuckDB.
REC = r"""rec AS (SELECT doc_id AS ord, 'doc:' || doc_id AS id,
  CASE doc_id % 3 WHEN 1 THEN 'https://doi.org/10.1/' || md5(text) WHEN 2 THEN 'DOI:10.1/' || upper(md5(text)) END AS doi,
  string_split(text, chr(10))[1] AS title, CAST(1990 + doc_id % 35 AS INTEGER) AS publication_year,
  CASE WHEN doc_id % 13 <> 0 THEN lang END AS language,
  CASE doc_id % 7 WHEN 0 THEN 'article' WHEN 1 THEN 'thesis' WHEN 2 THEN 'Dissertation' WHEN 3 THEN 'Editorial' WHEN 5 THEN 'book-chapter' WHEN 6 THEN 'letter' END AS type,
  CASE WHEN doc_id % 11 <> 0 THEN text END AS abstract,
  CASE WHEN doc_id % 19 = 0 THEN '' WHEN doc_id % 17 = 0 THEN array_to_string(list_transform(range(1, 31), lambda i: 'A' || i || ', X'), '; ')
    ELSE 'Last' || (doc_id % 50) || ', F; Last' || (doc_id % 7) || ', G' END AS authors,
  'Journal' AS source_journal_or_publisher, CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id % 40 AS INTEGER) END AS cited_by_count,
  CASE WHEN doc_id % 2 <> 0 THEN 'https://x/' || doc_id END AS open_access_url, source AS source_database FROM documents)"""


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(anchor_idx, embedding): the lowest vector of each label, in label order."""
    e = table(spark, sf_dir, "embeddings").groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding"))
    return e.select(F.col("label").alias("anchor_idx"), "embedding", F.concat(F.lit("Anchor "), F.col("label").cast("string"), F.lit(". Text")).alias("text"))


ANCHORS = "anc AS (SELECT label AS anchor_idx, arg_min(embedding, vec_id) AS v FROM embeddings GROUP BY label)"
_UNIT = "list_transform(CAST({v} AS DOUBLE[]), lambda x: x / CASE WHEN sqrt(list_inner_product(CAST({v} AS DOUBLE[]), CAST({v} AS DOUBLE[]))) = 0 THEN 1 ELSE sqrt(list_inner_product(CAST({v} AS DOUBLE[]), CAST({v} AS DOUBLE[]))) END)"
SIMS = (
    f"unit_a AS (SELECT anchor_idx, {_UNIT.format(v='v')} AS v FROM anc), unit_e AS (SELECT vec_id, {_UNIT.format(v='embedding')} AS e FROM embeddings), "
    "sims AS (SELECT vec_id, anchor_idx, round(list_inner_product(v, e), 9) AS s FROM unit_e, unit_a), "
    "best AS (SELECT vec_id, max(s) AS embed_score, CAST(arg_max(anchor_idx, struct_pack(s := s, i := -anchor_idx)) AS INTEGER) AS embed_top_anchor FROM sims GROUP BY vec_id)"
)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with their best anchor."""
    from ..operators.vectors import score_anchors

    return score_anchors(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("ord"), "embedding"), anchors(spark, sf_dir)).drop("embedding")


def relevance_of(quality: Column, toxic: Column) -> Column:
    return F.when((quality == 1) & (toxic == 0), "core").when(quality == 1, "adjacent").otherwise("off_topic")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "labels")
    return t.select(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("id"), relevance_of(F.col("quality"), F.col("toxic")).alias("relevance_llm"), "toxic")


LABELS = "lab AS (SELECT 'doc:' || doc_id AS id, CASE WHEN quality = 1 AND toxic = 0 THEN 'core' WHEN quality = 1 THEN 'adjacent' ELSE 'off_topic' END AS relevance_llm, toxic FROM labels)"


def second_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd records under new identifiers, and the benchmark items as records."""
    rec = records(spark, sf_dir)
    odd = rec.where("ord % 2 = 1").withColumn("id", F.concat(F.lit("second:"), F.col("ord").cast("string"))).withColumn("ord", F.col("ord") + (1 << 40))
    items = table(spark, sf_dir, "benchmark").select(
        (F.col("item_id") + (1 << 41)).alias("ord"), F.concat(F.lit("item:"), F.col("item_id").cast("string")).alias("id"),
        F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("abstract"), F.lit("benchmark").alias("source_database"),
    )
    return odd.unionByName(items, allowMissingColumns=True)


SECOND = """sec AS (SELECT * REPLACE ('second:' || ord AS id, ord + 1099511627776 AS ord) FROM rec WHERE ord % 2 = 1
  UNION ALL BY NAME SELECT item_id + 2199023255552 AS ord, 'item:' || item_id AS id, string_split(text, chr(10))[1] AS title, text AS abstract, 'benchmark' AS source_database FROM benchmark)"""


def citation_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works cite works: orders cite parts, in line order."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ord"))
