"""BibTeX entries as expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_rank
from .text import blank_to_null


def escape(c: Column) -> Column:
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("{"), F.lit("\\{")), F.lit("}"), F.lit("\\}"))


def authors(c: Column) -> Column:
    parts = F.transform(F.split(c, ";"), lambda p: F.trim(p))
    return F.nullif(F.array_join(F.filter(parts, lambda p: p != ""), " and "), F.lit(""))


def entry_key(authors: Column, year: Column, publication_year: Column, title: Column) -> Column:
    text = lambda c: F.coalesce(blank_to_null(c.cast("string")), F.lit(""))
    first = F.substring_index(F.trim(F.substring_index(text(authors), ";", 1)), ",", 1)
    surname = F.coalesce(F.nullif(F.regexp_replace(first, "[^A-Za-z]+", ""), F.lit("")), F.lit("anon"))
    when = F.coalesce(F.nullif(text(year), F.lit("")), F.nullif(text(publication_year), F.lit("")), F.lit("n.d."))
    word = F.substring(F.regexp_replace(F.substring_index(text(title), " ", 1), "[^A-Za-z0-9]+", ""), 1, 20)
    return F.lower(F.concat(surname, when, F.coalesce(F.nullif(word, F.lit("")), F.lit("untitled"))))


def entry(df: DataFrame, key: Column) -> Column:
    """The entry text; fields without a value are left out."""
    kind = F.lower(F.coalesce(blank_to_null(df["type"]), F.lit("")))
    kind = (
        F.when(F.contains(kind, F.lit("thesis")) | F.contains(kind, F.lit("dissertation")), "phdthesis")
        .when(F.contains(kind, F.lit("book")) | F.contains(kind, F.lit("chapter")), "incollection")
        .otherwise("article")
    )
    fields = [("title", "title"), ("author", "authors"), ("year", "year"), ("journal", "source_journal_or_publisher"), ("doi", "doi"), ("url", "open_access_url"), ("language", "language"), ("note", "source_databases")]
    cells = []
    for name, col in fields:
        value = blank_to_null(df[col].cast("string")) if col in df.columns else F.lit(None).cast("string")
        value = authors(value) if name == "author" else value
        cells.append(F.when(value.isNotNull(), F.concat(F.lit(f"{name} = {{"), escape(value), F.lit("}"))))
    body = F.array_join(F.array_compact(F.array(*cells)), ",\n  ")
    return F.concat(F.lit("@"), kind, F.lit("{"), key, F.lit(",\n  "), body, F.lit("\n}\n"))


def _letter(code: Column) -> Column:
    """The character of a code point (``char`` stops at 255)."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _replay(pdf: pd.DataFrame) -> pd.DataFrame:
    used, keys = set(), []
    for base in pdf.sort_values("_ord")["_base"]:
        key, n = base, 0
        while key in used:
            key, n = f"{base}{chr(97 + n)}", n + 1
        used.add(key)
        keys.append(key)
    return pd.DataFrame({"_ord": pdf.sort_values("_ord")["_ord"], "bib_key": keys})


def with_keys(df: DataFrame, order: str) -> DataFrame:
    """Add ``bib_key``: repeats of a key get a, b, c, ... in row order, past any key already in use.

    ``order`` is unique.  A suffixed key can only meet a natural key with the same surname and year,
    so only such groups with a real clash are replayed in order; all others take a row number.
    """
    base = entry_key(df["authors"], df["year"], df["publication_year"], df["title"])
    # Numbered over ranges: records without authors, year and title may all share one key.
    placed = global_rank(df.select(F.col(order).alias("_ord"), base.alias("_base")), ["_base", "_ord"], "_place")
    placed = placed.withColumn("_root", F.regexp_extract("_base", "^([a-z]*[^a-z]*)", 1))
    firsts = placed.groupBy("_base").agg(F.min("_place").alias("_first"))
    tried = placed.join(firsts, "_base").withColumn("_n", F.col("_place") - F.col("_first"))
    tried = tried.withColumn("bib_key", F.when(F.col("_n") == 0, F.col("_base")).otherwise(F.concat("_base", _letter(F.lit(96) + F.col("_n")))))
    clash = tried.where("_n > 0").join(firsts.select(F.col("_base").alias("bib_key")), "bib_key", "left_semi").select("_root").distinct()
    replayed = placed.join(clash, "_root", "left_semi").select("_root", "_base", "_ord").groupBy("_root").applyInPandas(_replay, "_ord long, bib_key string")
    keys = tried.join(replayed.withColumnRenamed("bib_key", "_fixed"), "_ord", "left").select("_ord", F.coalesce("_fixed", "bib_key").alias("bib_key"))
    return df.join(keys, F.col(order) == F.col("_ord")).drop("_ord")
