"""Raw responses to the record schema: one expression set for each source.

Input is (source, query, payload_json), the archive schema; a payload is parsed once and its records
are exploded.  Sources that answer in HTML or XML go through ``html_scan``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import nested as N
from ..functions import text as T
from ..operators.ranking import global_rank
from ..schema import RECORD
from . import html_scan

RAW_CHARS = 5000


def _or(*cs: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[N.truthy(c) for c in cs])


def _names(v: Column, p: str, name: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.array_join(F.filter(F.transform(N.as_list(v, p), name), lambda x: x != ""), "; "), F.lit(""))


def _null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _doi_url(doi: Column) -> Column:
    return F.concat(F.lit("https://doi.org/"), N.truthy(doi))


def _index_text(v: Column) -> Column:
    return N.inverted_index_text(F.try_variant_get(v, "$.abstract_inverted_index", "map<string,array<int>>"))


def _openalex(v):
    p = lambda x, k="string": N.path(v, x, k)
    return dict(
        id=p("id"), doi=p("doi"), title=_or(p("display_name"), p("title")), publication_year=p("publication_year", "int"), language=p("language"), type=p("type"),
        abstract=_index_text(v), authors=_names(v, "authorships", lambda a: F.coalesce(N.path(a, "author.display_name"), F.lit(""))),
        source_journal_or_publisher=p("primary_location.source.display_name"), cited_by_count=p("cited_by_count", "int"), open_access_url=p("open_access.oa_url"),
    )


def _semantic_scholar(v):
    p = lambda x, k="string": N.path(v, x, k)
    return dict(
        id=p("paperId"), doi=p("externalIds.DOI"), title=p("title"), publication_year=p("year", "int"), language=_null(), type=_null(), abstract=p("abstract"),
        authors=_names(v, "authors", lambda a: F.coalesce(N.path(a, "name"), F.lit(""))), source_journal_or_publisher=p("venue"),
        cited_by_count=p("citationCount", "int"), open_access_url=p("openAccessPdf.url"),
    )


def _wos(v):
    p = lambda x, k="string": N.path(v, x, k)
    return dict(
        id=p("uid"), doi=p("identifiers.doi"), title=F.coalesce(p("title.value"), p("title")), publication_year=F.coalesce(p("source.publishYear", "int"), p("publishedBiblioYear", "int")),
        language=_null(), type=p("documentType"), abstract=_null(),
        authors=_names(v, "names.authors", lambda a: F.coalesce(N.truthy(N.path(a, "displayName")), N.path(a, "wosStandard"), F.lit(""))),
        source_journal_or_publisher=p("source.sourceTitle"), cited_by_count=N.path(N.first(v, "citations"), "count", "int"), open_access_url=_null(),
    )


def _wos_expanded(v):
    return dict(
        id=N.path(v, "UID"), doi=N.wos_doi(v), title=N.wos_title(v), publication_year=N.wos_year(v), language=N.wos_language(v), type=N.wos_doctype(v), abstract=N.wos_abstract(v),
        authors=N.wos_authors(v), source_journal_or_publisher=N.wos_journal(v), cited_by_count=N.wos_citations(v), open_access_url=_null(),
    )


def _hal(v):
    one = lambda x: N.path(N.first(v, x), "")
    return dict(
        id=F.concat(F.lit("hal:"), F.coalesce(N.path(v, "docid"), F.lit("None"))), doi=N.path(v, "doiId_s"), title=one("title_s"), publication_year=T.year_prefix(N.path(v, "producedDate_s")),
        language=one("language_s"), type=F.lit("thesis"), abstract=one("abstract_s"), authors=_names(v, "authFullName_s", lambda a: F.coalesce(N.path(a, ""), F.lit(""))),
        source_journal_or_publisher=F.lit("HAL/TEL"), cited_by_count=_null("int"), open_access_url=N.path(v, "uri_s"),
    )


def _theses_fr(v):
    p = lambda x: N.path(v, x)
    people = F.when(F.size(N.as_list(v, "auteurs")) > 0, _names(v, "auteurs", _person)).otherwise(_names(v, "authors", _person))
    return dict(
        id=F.concat(F.lit("theses_fr:"), F.coalesce(_or(p("id"), p("nnt")), F.lit("None"))), doi=_null(), title=_or(p("titrePrincipal"), p("titre")),
        publication_year=T.year_prefix(_or(p("dateSoutenance"), p("annee"))), language=p("langue"), type=F.lit("thesis"), abstract=p("resume"), authors=people,
        source_journal_or_publisher=_or(p("etablissementSoutenance"), p("etablissement")), cited_by_count=_null("int"), open_access_url=p("accessibleEnLigne"),
    )


def _person(a):
    return F.coalesce(N.truthy(N.path(a, "nom_complet")), N.path(a, "nom"), F.lit(""))


def _europepmc(v):
    p = lambda x, k="string": N.path(v, x, k)
    urls = F.filter(F.transform(N.as_list(v, "fullTextUrlList.fullTextUrl"), lambda u: N.path(u, "url")), lambda u: F.coalesce(u, F.lit("")) != "")
    return dict(
        id=F.concat(F.lit("epmc:"), F.coalesce(p("source"), F.lit("PPR")), F.lit(":"), F.coalesce(_or(p("id"), p("doi")), F.lit("None"))), doi=p("doi"), title=p("title"),
        publication_year=p("pubYear", "int"), language=_null(), type=F.get(F.try_variant_get(v, "$.pubTypeList.pubType", "array<string>"), F.lit(0)),
        abstract=N.truthy(T.strip_markup(p("abstractText"))), authors=p("authorString"),
        source_journal_or_publisher=F.coalesce(_or(p("journalTitle"), p("bookOrReportDetails.publisher")), F.lit("Europe PMC")), cited_by_count=p("citedByCount", "int"),
        open_access_url=F.coalesce(F.get(urls, F.lit(0)), _doi_url(p("doi"))),
    )


def _crossref_like(v, key: str, kind: Column, venue: Column):
    p = lambda x, k="string": N.path(v, x, k)
    title = N.path(N.first(v, "title"), "")
    return dict(
        id=F.concat(F.lit(f"{key}:"), F.coalesce(N.truthy(p("DOI")), N.truthy(F.substring(title, 1, 80)), F.lit("unknown"))), doi=p("DOI"), title=title,
        publication_year=F.try_variant_get(v, "$.published['date-parts'][0][0]", "int"), language=p("language"), type=kind, abstract=N.truthy(T.strip_markup(p("abstract"))),
        authors=N.family_given(N.as_list(v, "author")), source_journal_or_publisher=venue, cited_by_count=_null("int"), open_access_url=F.coalesce(N.truthy(p("URL")), _doi_url(p("DOI"))),
    )


def _eartharxiv(v):
    return _crossref_like(v, "eartharxiv", F.lit("preprint"), F.coalesce(N.truthy(N.path(v, "publisher")), F.lit("EarthArXiv")))


def _crossref(v):
    container = F.try_variant_get(v, "$['container-title'][0]", "string")
    return _crossref_like(v, "crossref", N.path(v, "type"), F.coalesce(_or(container, N.path(v, "publisher")), F.lit("Crossref")))


def _core(v):
    p = lambda x, k="string": N.path(v, x, k)
    people = N.as_list(v, "authors")
    return dict(
        id=F.concat(F.lit("core:"), F.coalesce(_or(p("id"), p("doi"), F.substring(p("title"), 1, 80)), F.lit("unknown"))), doi=p("doi"), title=N.truthy(p("title")),
        publication_year=p("yearPublished", "int"), language=p("language.code"), type=p("documentType"), abstract=N.truthy(p("abstract")),
        authors=F.when(F.size(people) > 25, "").otherwise(_names(v, "authors", lambda a: F.coalesce(N.path(a, "name"), F.lit("")))),
        source_journal_or_publisher=F.coalesce(N.truthy(p("publisher")), F.lit("CORE")), cited_by_count=p("citationCount", "int"),
        open_access_url=F.coalesce(F.try_variant_get(v, "$.sourceFulltextUrls[0]", "string"), _doi_url(p("doi"))),
    )


#: Source key: where its records are in a payload, the field expressions, and whether a title is required.
JSON_SOURCES: dict[str, tuple[tuple[str, ...], Callable[[Column], dict[str, Column]], bool]] = {
    "openalex": (("results", ""), _openalex, False),
    "semantic_scholar": (("data",), _semantic_scholar, False),
    "wos": (("hits",), _wos, False),
    "wos_expanded": (("Data.Records.records.REC",), _wos_expanded, False),
    "hal": (("response.docs",), _hal, False),
    "theses_fr": (("theses", "results", "items"), _theses_fr, False),
    "europepmc": (("resultList.result",), _europepmc, False),
    "eartharxiv": (("message.items",), _eartharxiv, False),
    "crossref": (("message.items",), _crossref, False),
    "core": (("results",), _core, True),
}
#: Sources whose payload is a page: {"html": ...}, {"xml": ...} or the page itself.
PAGE_SOURCES = {"base": html_scan.base_records, "bdtd": html_scan.bdtd_records, "scielo": html_scan.scielo_records}
#: Without keys, and without what a richer connector repeats.
DEFAULT_SOURCES = ("openalex", "semantic_scholar", "wos_expanded", "hal", "theses_fr", "bdtd", "scielo", "europepmc", "eartharxiv", "crossref", "core")


def payload_records(raw: DataFrame, paths: tuple[str, ...]) -> DataFrame:
    """(source, query, pos, rec): the records of JSON payloads, at the first path that holds some."""
    v = F.col("_v")
    lists = [F.when(F.size(N.as_list(v, p)) > 0, F.try_variant_get(v, "$", "array<variant>") if not p else N.as_list(v, p)) for p in paths]
    return raw.withColumn("_v", N.variant(F.col("payload_json"))).select("source", "query", F.posexplode(F.coalesce(*lists)).alias("pos", "rec"))


def _ordered(raw: DataFrame, source: str) -> DataFrame:
    """Records of one source's raw responses, with the query and the place in its response."""
    own = raw.where(F.col("source") == source)
    if source in PAGE_SOURCES:
        return PAGE_SOURCES[source](own)
    paths, fields, titled = JSON_SOURCES[source]
    rec = payload_records(own, paths)
    cols = fields(F.col("rec")) | {"raw": F.substring(F.to_json("rec"), 1, RAW_CHARS), "source_database": F.lit(source)}
    out = rec.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in RECORD.fields], "query", "pos")
    return out.where("title is not null") if titled else out


def normalize(raw: DataFrame, source: str) -> DataFrame:
    """Records of one source's raw responses."""
    return _ordered(raw, source).select(*RECORD.names)


def resolve_sources(wanted: str | None, known) -> list[str]:
    """Source keys of a comma-separated argument; unknown ones raise."""
    if not wanted:
        return [s for s in DEFAULT_SOURCES if s in known]
    keys = [s.strip() for s in wanted.split(",") if s.strip()]
    if unknown := [s for s in keys if s not in known]:
        raise ValueError(f"unknown sources {unknown}; known are {sorted(known)}")
    return keys


def harvest(raw: DataFrame, sources: list[str], queries: list[str] | None = None) -> DataFrame:
    """All sources' records; ``ord`` counts by source, query (as listed, then by name) and place in the response.

    A source that repeats an identifier over its queries keeps the first, where it asks for that.
    """
    place = F.array_position(F.array(*[F.lit(q) for q in queries]), F.col("query")) if queries else F.lit(0)
    by = ["_s", "_q", "query", "pos", "id", "title"]
    parts = []
    for i, s in enumerate(sources):
        part = _ordered(raw, s).withColumn("_s", F.lit(i)).withColumn("_q", F.when(place > 0, place).otherwise(1 << 30))
        if s == "openalex":
            first = Window.partitionBy("id").orderBy(*by[1:])
            once = part.where("id is not null").withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
            part = part.where("id is null").unionByName(once)
        parts.append(part)
    return global_rank(reduce(DataFrame.unionByName, parts), [F.col(c) for c in by], "ord").drop("_s", "_q", "query", "pos")
