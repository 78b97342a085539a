"""Extraction from nested JSON whose paths hold an object, a list or a scalar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import trim_ws


def inverted_index_text(index: Column) -> Column:
    """Text of a map word -> positions: pairs in order of (position, word)."""
    pairs = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    text = F.array_join(F.transform(F.array_sort(pairs), lambda x: x["w"]), " ")
    return F.when(index.isNull() | (F.cardinality(index) == 0), F.lit(None)).otherwise(F.nullif(text, F.lit("")))


def variant(json: Column) -> Column:
    return F.try_parse_json(json)


def path(v: Column, p: str, kind: str = "string") -> Column:
    """Value at a path; null where a step is no object or the value is of another kind."""
    return F.try_variant_get(v, f"$.{p}" if p else "$", kind)


def _json(v: Column, p: str) -> Column:
    return F.try_variant_get(v, f"$.{p}" if p else "$", "variant")


def as_list(v: Column, p: str = "") -> Column:
    """The list at ``p``; a single value is a list of one, missing is null."""
    return F.coalesce(
        F.try_variant_get(v, f"$.{p}" if p else "$", "array<variant>"),
        F.when(_json(v, p).isNotNull(), F.array(_json(v, p))),
    )


def first(v: Column, p: str = "") -> Column:
    """The value at ``p``, or the first of a list there."""
    return F.get(as_list(v, p), F.lit(0))


def truthy(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def safe_int(c: Column) -> Column:
    return F.nullif(c, F.lit("")).try_cast("int")


def date_parts_year(v: Column, p: str) -> Column:
    return F.try_variant_get(v, f"$.{p}.date-parts[0][0]" if "-" not in p else f"$['{p}']['date-parts'][0][0]", "int")


def family_given(authors: Column) -> Column:
    """``Family, Given`` of each author, joined; ``authors``: array of variants."""
    one = lambda a: F.trim(
        F.concat(F.coalesce(path(a, "family"), F.lit("")), F.lit(", "), F.coalesce(path(a, "given"), F.lit(""))), F.lit(", ")
    )
    return F.coalesce(F.array_join(F.filter(F.transform(authors, one), lambda x: x != ""), "; "), F.lit(""))


def alternatives(v: Column, *keys: str) -> Column:
    """The first key with a text, or with a list whose first element is one; trimmed."""
    return F.coalesce(*[F.nullif(F.trim(path(first(v, k), "")), F.lit("")) for k in keys])


# ------------------------------------------------------------------ the deeply nested record of S4
_META, _SUMMARY = "static_data.fullrecord_metadata", "static_data.summary"


def wos_title(v: Column) -> Column:
    titles = F.filter(as_list(v, f"{_SUMMARY}.titles.title"), lambda t: path(t, "type") == "item")
    return path(F.get(titles, F.lit(0)), "content")


def wos_authors(v: Column) -> Column:
    people = F.filter(as_list(v, f"{_SUMMARY}.names.name"), lambda n: F.coalesce(truthy(path(n, "role")), F.lit("author")) == "author")
    names = F.transform(people, lambda n: F.coalesce(truthy(path(n, "display_name")), truthy(path(n, "full_name")), truthy(path(n, "wos_standard"))))
    return F.coalesce(F.array_join(F.array_compact(names), "; "), F.lit(""))


def wos_doi(v: Column) -> Column:
    ids = as_list(v, "dynamic_data.cluster_related.identifiers.identifier")
    return path(F.get(F.filter(ids, lambda i: F.lower(F.coalesce(path(i, "type"), F.lit(""))) == "doi"), F.lit(0)), "value")


def wos_abstract(v: Column) -> Column:
    p = as_list(first(v, f"{_META}.abstracts.abstract"), "abstract_text.p")
    return truthy(F.array_join(F.array_compact(F.transform(p, lambda x: path(x, ""))), " "))


def wos_year(v: Column) -> Column:
    info = F.try_variant_get(v, f"$.{_SUMMARY}.pub_info", "variant")
    return safe_int(F.coalesce(truthy(F.try_variant_get(info, "$['@pubyear']", "string")), truthy(path(info, "pubyear"))))


def wos_doctype(v: Column) -> Column:
    return path(first(v, f"{_SUMMARY}.doctypes.doctype"), "")


def wos_journal(v: Column) -> Column:
    titles = F.filter(as_list(v, f"{_SUMMARY}.titles.title"), lambda t: path(t, "type").isin("source", "source_abbrev"))
    return path(F.get(titles, F.lit(0)), "content")


def wos_language(v: Column) -> Column:
    return path(first(v, f"{_META}.languages.language"), "content")


def wos_citations(v: Column) -> Column:
    tc = first(v, "dynamic_data.citation_related.tc_list.silo_tc")
    return safe_int(F.coalesce(truthy(F.try_variant_get(tc, "$['@local_count']", "string")), truthy(path(tc, "local_count"))))


def label_json(reply: Column) -> Column:
    """A model's reply without a code fence around it."""
    s = trim_ws(reply)
    opened = F.regexp_replace(s, "^```[^\n]*\n", "")
    closed = F.when(s.startswith("```"), F.regexp_replace(opened, "```$", "")).otherwise(s)
    return trim_ws(closed)
