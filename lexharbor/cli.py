"""Command line: one subcommand for each pipeline.

Tables are Parquet folders; a project is a JSON file with ``vocab`` (axis -> tag -> surface forms),
``block`` (title substrings), ``anchors`` (texts in order), ``system_prompt`` and ``sources``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import merge
from .plans import layout, pipelines
from .sources import archive, files, normalize


def _options(parser: argparse.ArgumentParser) -> argparse.ArgumentParser:
    sub = parser.add_subparsers(dest="command", required=True)

    def add(name: str, *args, **kw):
        p = sub.add_parser(name, help=kw.pop("help", None))
        for a in args:
            flags, spec = a if isinstance(a, tuple) else (a, {})
            p.add_argument(flags, **spec)
        return p

    out = ("--out", {"required": True})
    project = ("--project", {"required": True})
    number = lambda flag, default, kind=float: (flag, {"type": kind, "default": default})
    add("harvest", "raw", project, out, "--sources", "--doi-exclude", ("--bibtex", {}), help="raw folder to ranked bibliography")
    add("embed", "table", project, out, ("--embed-backend", {"default": "hashing"}), ("--model", {"default": "bge-m3"}), ("--host", {"default": "http://localhost:11434"}), number("--batch-size", 32, int), "--cache", number("--part", 0, int), help="vectors and best anchors")
    add("diagnose", "table", project, number("--min-score", 0.45), number("--top-k", 3, int), "--markdown", help="anchor coverage report")
    add("label", "table", project, out, number("--min-score", 0.45), number("--max-score", None), number("--limit", None, int), ("--label-backend", {"default": "rules"}), "--api-key", "--api-url", "--model", "--host", "--pattern", "--log", "--require-column", number("--min-interval-s", 0.0), help="model labels")
    add("backfill", "table", "raw", out, ("--lookup", {"action": "append", "default": [], "metavar": "NAME=TABLE:CAP"}), "--uids", help="missing abstracts")
    add("merge", "main", "gap", out, ("--dry-run", {"action": "store_true"}), help="gap-fill merge")
    add("chase", "table", "works", "edges", project, out, number("--top-n", 20, int), number("--cap-per-seed", 500, int), help="one citation away")
    add("add-queries", "table", "raw", project, out, ("--query", {"action": "append", "required": True}), help="records of further queries")
    add("screen", "export", project, out, ("--axis", {"required": True}), ("--only", {"required": True}), help="screen a tagged export")
    add("compare", "left", "right", out, number("--title-threshold", 0.85), help="overlap of two corpora")
    add("novelty", "found", "table", project, out, help="novelty of found records")
    add("recover-sources", "table", "bib", out, help="sources from BibTeX notes")
    add("archive", "raw", out, help="verified archive of a raw folder")
    add("layout", "list", help="plan of moves for a list of file names")
    add("move", "folder", help="move the files of a results folder by plan, all or none")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame | str | dict:
    a = _options(argparse.ArgumentParser("lexharbor")).parse_args(argv)
    spark = spark or SparkSession.builder.appName("lexharbor").getOrCreate()
    project = json.load(open(a.project, encoding="utf-8")) if getattr(a, "project", None) else {}
    vocab, block = project.get("vocab", {}), project.get("block", [])
    read = spark.read.parquet
    anchors = lambda: spark.createDataFrame(list(enumerate(project["anchors"])), "anchor_idx int, text string")

    if a.command == "harvest":
        known = {**normalize.JSON_SOURCES, **normalize.PAGE_SOURCES}
        exclude = files.list_file(spark, a.doi_exclude).withColumnRenamed("value", "doi") if a.doi_exclude else None
        df = pipelines.harvest(files.raw_folder(spark, a.raw), normalize.resolve_sources(a.sources or ",".join(project.get("sources", [])), known), vocab, block, exclude)
        if a.bibtex:
            archive.write_bibtex(df.withColumn("publication_year", F.col("year")), a.bibtex)
    elif a.command == "embed":
        options = {"model": a.model, "host": a.host, "batch_size": a.batch_size}
        cache = pipelines.update_vector_cache(read(a.table), a.cache, a.part, a.embed_backend, **options) if a.cache else None
        df = pipelines.embed_and_score(read(a.table), anchors(), cache, a.embed_backend, **options)
    elif a.command == "diagnose":
        text = pipelines.diagnose(read(a.table), anchors(), a.min_score, a.top_k)
        if a.markdown:
            with open(a.markdown, "w", encoding="utf-8") as f:
                f.write(text)
        return text
    elif a.command == "label":
        options = {k: v for k, v in (("api_key", a.api_key), ("api_url", a.api_url), ("model", a.model), ("host", a.host), ("pattern", a.pattern), ("min_interval_s", a.min_interval_s)) if v is not None}
        df = pipelines.label(read(a.table), a.min_score, a.max_score, a.limit, read(a.log) if a.log else None, a.require_column, project.get("system_prompt", ""), a.label_backend, **options)
    elif a.command == "backfill":
        lookups = []
        for spec in a.lookup:
            name, _, rest = spec.partition("=")
            table, _, cap = rest.rpartition(":")
            lookups.append((name, read(table), int(cap)))
        df = pipelines.backfill(read(a.table), files.raw_folder(spark, a.raw), lookups, read(a.uids) if a.uids else None)
    elif a.command == "merge":
        main_table = read(a.main)
        df = merge.gap_fill_merge(main_table, read(a.gap))
        if a.dry_run:
            return {"main": main_table.count(), "merged": df.count()}
    elif a.command == "chase":
        df = pipelines.append_ranked(read(a.table), pipelines.chase(read(a.table), read(a.works), read(a.edges), vocab, a.top_n, a.cap_per_seed, block))
    elif a.command == "add-queries":
        df = pipelines.add_queries(read(a.table), files.raw_folder(spark, a.raw), a.query, vocab, block=block)
    elif a.command == "screen":
        df = pipelines.screen_export(spark, a.export, vocab, a.axis, a.only, block)
    elif a.command == "compare":
        tables = pipelines.comparison_tables(read(a.left), read(a.right), a.title_threshold)
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{a.out}/{name}")
        return {name: spark.read.parquet(f"{a.out}/{name}").count() for name in tables}
    elif a.command == "novelty":
        df = pipelines.gap_novelty(read(a.found), read(a.table), vocab)
    elif a.command == "recover-sources":
        df = pipelines.recover_sources(spark, read(a.table), a.bib)
    elif a.command == "archive":
        return archive.archive_verified(files.raw_folder(spark, a.raw), a.out)
    elif a.command == "move":
        return dict(layout.apply_moves(spark, a.folder))
    else:
        return layout.plan_moves(spark.read.text(a.list).withColumnRenamed("value", "name"))
    df.write.mode("overwrite").parquet(a.out)
    return spark.read.parquet(a.out)


if __name__ == "__main__":
    result = main()
    print(result if isinstance(result, (str, dict)) else f"{result.count()} rows")
