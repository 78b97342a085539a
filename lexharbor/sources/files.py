"""File scans: tagged text, BibTeX, lists, raw JSON folders, corpora."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nested as N
from ..functions import text as T
from ..schema import RECORD
from .normalize import JSON_SOURCES, payload_records

# Tags that are kept, tags with a value on each line, publication types.
KEPT_TAGS = ("PT", "AU", "AF", "TI", "SO", "AB", "DI", "PY", "PD", "TC", "UT", "VL", "IS", "BP", "EP", "AR", "DT", "LA")
LIST_TAGS = ("AU", "AF", "C1", "RP", "EM", "OI", "RI")
#: Two capitals or digits, not digits only, and a blank; the end mark of a file is no tag.
_TAG_LINE = re.compile(r"(?!EF)(?=\d?[A-Z])([A-Z0-9]{2}) ")
PUBLICATION_TYPE = {"J": "article", "B": "book", "S": "series", "C": "proceedings"}


def parse_tagged(record: str) -> dict[str, list[str]]:
    """Tag -> values of one record: list tags by line, other tags joined by blanks; unknown tags end a value."""
    out: dict[str, list[str]] = {}
    tag = None
    for line in record.split("\n"):
        opens, value = _TAG_LINE.match(line), line[3:].rstrip("\r")
        if opens:
            tag = opens[1] if opens[1] in KEPT_TAGS else None
            out |= {tag: [value]} if tag else {}
        elif tag and line.startswith("   "):
            out[tag] = [*out[tag], value] if tag in LIST_TAGS else [" ".join([*out[tag], value]).strip()]
    return out


def tagged_records(spark: SparkSession, path: str) -> DataFrame:
    """(ord, tags map<string,array<string>>): one row for each record of a tagged export."""
    rows = spark.read.option("lineSep", "\nER").text(path).withColumn("ord", F.monotonically_increasing_id())

    def run(batches):
        for pdf in batches:
            # Without a record in a batch, pandas would give the column a type that Arrow makes no maps of.
            pdf = pdf.assign(tags=pd.Series([parse_tagged(v) for v in pdf["value"]], index=pdf.index, dtype=object))
            yield pdf.loc[pdf["tags"].map(len).to_numpy(dtype=np.int64) > 0, ["ord", "tags"]]

    return rows.select("ord", "value").mapInPandas(run, "ord long, tags map<string,array<string>>")


def tagged_to_records(df: DataFrame) -> DataFrame:
    """Tagged records in the record schema."""
    tag = lambda t: F.get(F.col("tags")[t], F.lit(0))
    kinds = F.create_map(*[F.lit(x) for kv in PUBLICATION_TYPE.items() for x in kv])
    pt = F.nullif(F.trim(tag("PT")), F.lit(""))
    title = F.nullif(tag("TI"), F.lit(""))
    cols = dict(
        id=F.concat(F.lit("wos:"), F.coalesce(tag("UT"), F.lit("None"))), doi=tag("DI"), title=title, publication_year=N.safe_int(tag("PY")),
        language=F.coalesce(N.truthy(tag("LA")), T.infer_language(title)), type=F.coalesce(kinds[pt], pt), abstract=tag("AB"),
        authors=F.coalesce(F.array_join(F.col("tags")["AF"], "; "), F.array_join(F.col("tags")["AU"], "; "), F.lit("")),
        source_journal_or_publisher=tag("SO"), cited_by_count=N.safe_int(tag("TC")), open_access_url=F.lit(None), raw=F.to_json("tags"), source_database=F.lit("wos_export"),
    )
    return df.select("ord", *[cols[f.name].cast(f.dataType).alias(f.name) for f in RECORD.fields])


def bib_notes(spark: SparkSession, path: str) -> DataFrame:
    """(doi, note) of a BibTeX file; of entries with one DOI the last counts."""
    rows = spark.read.option("lineSep", "\n@").text(path).withColumn("_o", F.monotonically_increasing_id())
    field = lambda name: F.regexp_extract("value", rf"(?m)^\s*{name}\s*=\s*\{{(.*)\}}\s*,?\s*$", 1)
    found = rows.select(T.normalize_doi(field("doi")).alias("doi"), field("note").alias("note"), "_o").where("doi is not null and note <> ''")
    return found.groupBy("doi").agg(F.max_by("note", "_o").alias("note"))


def list_file(spark: SparkSession, path: str) -> DataFrame:
    """(value): lines of a list, trimmed, lower case, without blanks."""
    return spark.read.text(path).select(F.lower(T.trim_ws(F.col("value"))).alias("value")).where("value <> ''").distinct()


def exclude_lists(spark: SparkSession, *paths: str) -> DataFrame:
    """(value): the union of several lists, each value once."""
    out = list_file(spark, paths[0])
    for p in paths[1:]:
        out = out.unionByName(list_file(spark, p))
    return out.distinct()


def anchor_labels(spark: SparkSession, path: str) -> DataFrame:
    """(anchor_idx, label) of a JSON object {"0": "name", ...}."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("k", "label")).select(F.col("k").cast("int").alias("anchor_idx"), "label")


def corpus_dois(spark: SparkSession, path: str) -> DataFrame:
    """(doi): distinct DOIs of a CSV, TSV or Parquet corpus, sorted."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "parquet":
        df = spark.read.parquet(path)
    elif kind in ("csv", "tsv"):
        df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("sep", "\t" if kind == "tsv" else ",").csv(path)
    else:
        raise ValueError(f"{path}: neither csv, tsv nor parquet")
    return df.select(F.lower(F.trim(F.col("doi").cast("string"))).alias("doi")).where("doi <> ''").distinct().orderBy("doi")


def raw_folder(spark: SparkSession, path: str) -> DataFrame:
    """(source, query, payload_json) of a folder of raw responses named <source>__<query>.json."""
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")
    rest = F.regexp_replace(stem, "^.*?__", "")
    query = F.when(F.contains(stem, F.lit("__")) & (rest != ""), rest).otherwise("(no_query)")
    return spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(path).select(F.split_part(stem, F.lit("__"), F.lit(1)).alias("source"), query.alias("query"), F.col("value").alias("payload_json"))


#: Source: (identifier, abstract) of its cached records.
_CACHED = {
    "openalex": lambda v: (T.native_id(N.path(v, "id")), N.inverted_index_text(F.try_variant_get(v, "$.abstract_inverted_index", "map<string,array<int>>"))),
    "wos_expanded": lambda v: (N.path(v, "UID"), N.wos_abstract(v)),
    "semantic_scholar": lambda v: (F.coalesce(N.truthy(N.path(v, "paperId")), N.path(v, "externalIds.CorpusId")), N.alternatives(v, "abstract")),
    "hal": lambda v: (F.concat(F.lit("hal:"), F.coalesce(N.truthy(N.path(v, "halId_s")), N.truthy(N.path(v, "halId")), N.path(v, "docid"))), N.alternatives(v, "abstract_s", "abstract", "description_s", "description")),
    "theses_fr": lambda v: (N.path(v, "id"), N.alternatives(v, "resume", "abstract_s", "abstract", "description_s", "description")),
    "bdtd": lambda v: (F.coalesce(N.truthy(N.path(v, "id")), N.path(v, "url")), N.alternatives(v, "abstract", "description", "summary")),
}


def cached_abstracts(raw: DataFrame) -> DataFrame:
    """(key, text): abstracts by source-native identifier; of repeats the first file in name order counts."""
    out = None
    for source, pick in _CACHED.items():
        paths = JSON_SOURCES[source][0] if source in JSON_SOURCES else ("records", "")
        rec = payload_records(raw.where(F.col("source") == source), (*paths, "docs") if source in ("hal", "theses_fr") else paths)
        key, abstract = pick(F.col("rec"))
        one = rec.select(F.trim(key).alias("key"), F.trim(abstract).alias("text"), F.struct("source", "query", "pos").alias("_o")).where("key <> '' and text <> ''")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("key").agg(F.min_by("text", "_o").alias("text"))


def only_match(paths: list[str], what: str) -> str:
    """The one path of a glob; raises for none or several."""
    if len(paths) != 1:
        raise ValueError(f"{what}: {len(paths)} files match, one is needed")
    return paths[0]


def file_digest(content: Column) -> Column:
    return F.md5(content)
