"""Queries of file scans and sinks: what a sink writes to the shared folder, its scan reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import labels, reports
from ..operators._storage import saved, scratch
from ..sources import archive, files, replay
from . import layout, pipelines
from . import records as R
from .queries import VOCAB, _doi, query

c = F.col
_year = "publication_year"


@query(f"WITH {R.REC} SELECT ord, nullif(title, '') AS title, nullif(abstract, '') AS abstract, {_year} FROM rec")
def csv_round_trip(spark, sf):
    path = scratch(spark, "csv")
    archive.write_csv(R.records(spark, sf).select("ord", "title", "abstract", _year), path, single=False)
    back = archive.read_csv(spark, path, f"ord long, title string, abstract string, {_year} int")
    return back.select("ord", *[F.nullif(x, F.lit("")).alias(x) for x in ("title", "abstract")], _year)


@query(f"WITH {R.REC}, d AS (SELECT DISTINCT lower(doi) AS doi FROM rec WHERE doi IS NOT NULL) SELECT kind, doi FROM d, (VALUES ('csv'), ('tsv'), ('parquet')) AS k(kind)")
def corpus_dois(spark, sf):
    r, out = R.records(spark, sf).select("ord", "doi", "title"), None
    for kind in ("csv", "tsv", "parquet"):
        path = scratch(spark, "corpus") + f".{kind}"
        if kind == "parquet":
            r.write.parquet(path)
        else:
            r.write.option("header", True).option("escape", '"').option("sep", "\t" if kind == "tsv" else ",").csv(path)
        one = files.corpus_dois(spark, path).select(F.lit(kind).alias("kind"), "doi")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"WITH {R.REC} SELECT DISTINCT lower(doi) AS value FROM rec WHERE doi IS NOT NULL AND ord % 10 < 6")
def exclude_lists(spark, sf):
    """Two lists that overlap, with blanks and capitals."""
    r, paths = R.records(spark, sf), [scratch(spark, "list") for _ in range(2)]
    archive.write_lines(r.where("ord % 10 < 4").select(F.concat(F.lit(" "), F.upper("doi")).alias("v")).where("v is not null"), "v", paths[0])
    archive.write_lines(r.where("ord % 10 between 2 and 5").select(F.coalesce("doi", F.lit("")).alias("v")), "v", paths[1], order="v")
    return files.exclude_lists(spark, *paths)


@query("SELECT 'crossref' AS source, 'crossref__' || source || '__' || substring(sha1(source), 1, 10) || '.json' AS name, CAST(count(*) AS VARCHAR) AS payload_json FROM documents WHERE source IS NOT NULL GROUP BY documents.source")
def raw_folder(spark, sf):
    """A raw file for each source, read back as the archive schema."""
    d = R.table(spark, sf, "documents").where("source is not null").groupBy(c("source").alias("query")).agg(F.count(F.lit(1)).cast("string").alias("payload_json"))
    path = scratch(spark, "raw")
    archive.write_raw_files(d.withColumn("source", F.lit("crossref")), path)
    back = files.raw_folder(spark, path)
    return back.select("source", F.concat("source", F.lit("__"), "query", F.lit(".json")).alias("name"), "payload_json")


def _tagged(spark, sf) -> str:
    """Records as a tagged export."""
    n, path = c("ord").cast("string"), scratch(spark, "tagged")
    kind = F.when(c("ord") % 3 == 0, "J").when(c("ord") % 3 == 1, "B").otherwise("X")
    topic = F.when(c("ord") % 4 == 0, "the form").when(c("ord") % 4 == 1, "le la the").when(c("ord") % 4 == 2, "das").otherwise("nothing")
    rec = F.concat(
        F.lit("PT "), kind, F.lit("\nAU Doe, J\n   Roe, "), n, F.lit("\nTI Title "), n, F.lit(" on\n   "), topic, F.lit("\nXX skip\n   dropped\nPY "), c(_year), F.lit("\nTC "),
        F.coalesce(c("cited_by_count").cast("string"), F.lit("x")), F.lit("\nUT WOS:"), n, F.lit("\nER\n"),
    )
    archive.write_lines(R.records(spark, sf).select(rec.alias("v")), "v", path)
    return path


_TAGGED_TITLE = "'Title ' || ord || ' on ' || CASE ord % 4 WHEN 0 THEN 'the form' WHEN 1 THEN 'le la the' WHEN 2 THEN 'das' ELSE 'nothing' END"


@query(f"WITH {R.REC} SELECT 'wos:WOS:' || ord AS id, {_TAGGED_TITLE} AS title, {_year}, CASE ord % 3 WHEN 0 THEN 'article' WHEN 1 THEN 'book' ELSE 'X' END AS type, 'Doe, J; Roe, ' || ord AS authors, cited_by_count FROM rec")
def tagged_export(spark, sf):
    return files.tagged_to_records(files.tagged_records(spark, _tagged(spark, sf))).select("id", "title", _year, "type", "authors", "cited_by_count")


@query(f"WITH {R.REC} SELECT 'wos:WOS:' || ord AS id, CASE ord % 4 WHEN 0 THEN 'english_only' WHEN 1 THEN 'non_english' ELSE 'non_english' END AS relevance FROM rec WHERE ord % 4 <> 3")
def screen_export(spark, sf):
    """The export screened on one axis; some titles are blocked."""
    return pipelines.screen_export(spark, _tagged(spark, sf), VOCAB, "article", "english", ("nothing",)).select("id", "relevance")


@query(f"WITH {R.REC} SELECT {_doi('doi')} AS doi, any_value('n' || substring(md5({_doi('doi')}), 1, 6)) AS note FROM rec WHERE doi IS NOT NULL GROUP BY 1")
def bibtex_notes(spark, sf):
    """A bibliography written as BibTeX, and the provenance notes read back from it."""
    r = R.records(spark, sf).withColumn("year", c(_year)).withColumn("source_databases", F.concat(F.lit("n"), F.substring(F.md5(text.normalize_doi(c("doi"))), 1, 6)))
    path = scratch(spark, "bib")
    archive.write_bibtex(r, path)
    return files.bib_notes(spark, path)


@query("SELECT CAST(label AS INTEGER) AS anchor_idx, 'name ' || label AS label FROM (SELECT DISTINCT label FROM embeddings)")
def anchor_labels(spark, sf):
    path = scratch(spark, "anchor-labels")
    names = R.anchors(spark, sf).groupBy().agg(F.map_from_entries(F.collect_set(F.struct(c("anchor_idx").cast("string"), F.concat(F.lit("name "), "anchor_idx")))).alias("m"))  # one for each anchor
    archive.write_lines(names.select(F.to_json("m").alias("v")), "v", path)
    return files.anchor_labels(spark, path)


@query("SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS chunk FROM labels")
def label_checkpoints(spark, sf):
    """Two chunks, the second with later answers for some rows; they are cleared once all rows are there."""
    t, path = R.table(spark, sf, "labels").select(c("doc_id").alias("id"), "quality"), scratch(spark, "checkpoints")
    archive.append_checkpoint(t, path, 1)
    archive.append_checkpoint(t.where("id % 3 = 0"), path, 2)
    kept = saved(labels.last_checkpoint(spark.read.parquet(path)).select("id", "chunk"), "last")
    if not archive.clear_checkpoints(spark, path, t):
        raise AssertionError("all rows have a checkpoint")
    return kept


@query(f"WITH {R.REC} SELECT id FROM rec WHERE trim(COALESCE(title, '') || COALESCE(abstract, '')) <> ''")
def vector_cache(spark, sf):
    """A cache of vectors, grown by a second run that only computes what is missing."""
    r, path = R.records(spark, sf), scratch(spark, "vectors")
    pipelines.update_vector_cache(r.where("ord % 3 = 0"), path, 0)
    return pipelines.update_vector_cache(r, path, 1).where(F.abs(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)) > 0.5).select("id")


@query("SELECT page_id, md5(COALESCE(html, '')) AS digest FROM pages")
def file_digests(spark, sf):
    return R.table(spark, sf, "pages").select("page_id", files.file_digest(F.coalesce("html", F.lit("")).cast("binary")).alias("digest"))


@query("SELECT '[crossref]' || chr(9) || 'q' || doc_id || chr(9) || 'status=' || CASE WHEN doc_id % 2 = 0 THEN '503' ELSE 'NA' END AS value FROM documents WHERE doc_id % 5 = 0")
def error_log(spark, sf):
    d = R.table(spark, sf, "documents")
    failed = F.when(c("doc_id") % 5 == 0, F.when(c("doc_id") % 2 == 0, "status=503").otherwise("status=NA"))
    return replay.errors(d.select(F.lit("crossref").alias("source"), F.concat(F.lit("q"), "doc_id").alias("query"), failed.alias("error")))


@query(
    "WITH f AS (SELECT doc_id % 8 AS k, CASE doc_id % 8 WHEN 0 THEN 'run' || doc_id || '.log' WHEN 1 THEN 'x' || doc_id || '.bak' WHEN 2 THEN 'pilot' || doc_id || '_labeled.csv' WHEN 3 THEN 'gap_matrix_' || doc_id || '.csv' "
    "WHEN 4 THEN 'my_bibliography' || doc_id || '.csv' WHEN 5 THEN 'a' || doc_id || '_gap_scored.csv' WHEN 6 THEN 'a' || doc_id || '_gap.csv' ELSE 'keep' || doc_id || '.txt' END AS name, doc_id FROM documents) "
    "SELECT name, CASE k WHEN 0 THEN 'logs/' || name WHEN 1 THEN 'archive/' || name WHEN 2 THEN 'pilots/' || name WHEN 3 THEN 'analysis/' || name WHEN 5 THEN 'gapfills/a' || doc_id || '_gap/scored.csv' ELSE 'gapfills/a' || doc_id || '_gap/records.csv' END AS target FROM f WHERE k NOT IN (4, 7)"
)
def layout_plan(spark, sf):
    n, k = c("doc_id").cast("string"), c("doc_id") % 8
    shapes = [("run", ".log"), ("x", ".bak"), ("pilot", "_labeled.csv"), ("gap_matrix_", ".csv"), ("my_bibliography", ".csv"), ("a", "_gap_scored.csv"), ("a", "_gap.csv"), ("keep", ".txt")]
    name = F.lit(None).cast("string")
    for i, (head, tail) in enumerate(shapes):
        name = F.when(k == i, F.concat(F.lit(head), n, F.lit(tail))).otherwise(name)
    return layout.plan_moves(R.table(spark, sf, "documents").select(name.alias("name")))


@query(f"WITH {R.REC} SELECT round(avg(CASE WHEN ord % 4 = 0 THEN 0.0 ELSE 1.0 END), 6) AS covered, CAST(NULL AS VARCHAR) AS small_loss, 'source coverage collapsed in the merge: ' || CAST(round(100 * avg(CASE WHEN ord % 4 = 0 THEN 0.0 ELSE 1.0 END)) AS INTEGER) || '% before, 0% after' AS collapse FROM rec")
def coverage_guard(spark, sf):
    """The share of rows with a source, and what the guard says of a small loss and of a collapse."""
    r = R.records(spark, sf).withColumn("source_databases", F.when(c("ord") % 4 == 0, "").otherwise(c("source_database")))
    small = reports.check_source_coverage(r, r.withColumn("source_databases", F.when(c("ord") % 4 < 2, "").otherwise(c("source_database"))))
    gone = reports.check_source_coverage(r, r.withColumn("source_databases", F.lit("")))
    return reports.coverage_fraction(r).select(F.round("covered", 6).alias("covered"), F.lit(small).cast("string").alias("small_loss"), F.lit(gone).alias("collapse"))
