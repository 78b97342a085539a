"""A Python data source for every connector: replays the raw archive, or asks the service.

``spark.read.format("records").option("source", "crossref").option("archive", path)`` returns raw
responses as (source, query, payload_json, error); ``normalize`` makes records of them.  Archives are
read through any file system with a URI, a file a partition (``raw_folder`` is the same through Spark's
own reader).

Online, a **service** (the host that answers, for one source or several) is an input partition that
asks all its queries in order, so its pause lies between any two of its requests however many cores
there are; services are asked side by side.  A query follows its source's pages up to
``per_query_cap`` records and is one row, or one for each page that is kept with ``pages``; a query that
fails is a row with ``error``, so an outage does not look like an empty result.  Reading writes nothing:
``harvest`` asks once, keeps the pages in the shared folder and writes the raw files from there.

Defined results: without queries, or without a key that a source needs, there are no rows; a query
that several sources are asked is a row of each; repeated queries are asked again.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators._storage import saved
from .lookup import AGENT, EMAIL, WOS_URL, ask

#: Records of one query; a page is finished where the source cannot ask for fewer.
QUERY_CAP = 500


@dataclass(frozen=True)
class Endpoint:
    """How a source is asked: ``{key}`` and ``{email}`` in headers and parameters are filled from options."""

    url: str
    query: str
    fixed: dict = field(default_factory=dict)
    pause: float = 0.5
    headers: dict = field(default_factory=dict)
    key: str | None = None
    key_header: tuple[str, str] | None = None
    needs_key: bool = False
    keyed_pause: float | None = None
    page: str = "json"


# Addresses, parameters, header names, field lists and pauses of the services.
BROWSER = {
    "User-Agent": "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0 Safari/537.36",
    "Accept": "text/html,application/xhtml+xml",
    "Accept-Language": "en,es;q=0.8,pt;q=0.7",
}
POLITE = {"User-Agent": AGENT}
CROSSREF_FIELDS = "DOI,title,abstract,author,published,URL,publisher,container-title"
ENDPOINTS = {
    "openalex": Endpoint("https://api.openalex.org/works", "search", {"per_page": 200, "mailto": "{email}"}, 0.15),
    "semantic_scholar": Endpoint(
        "https://api.semanticscholar.org/graph/v1/paper/search", "query",
        {"limit": 100, "fields": "paperId,externalIds,title,year,abstract,authors,venue,citationCount,isOpenAccess,openAccessPdf,fieldsOfStudy"},
        3.5, key="semantic_scholar_key", key_header=("x-api-key", "{key}"), keyed_pause=1.0,
    ),
    "wos": Endpoint("https://api.clarivate.com/apis/wos-starter/v1/documents", "q", {"limit": 50, "page": 1, "db": "WOS"}, 1.0, {"accept": "application/json"}, "wos_key", ("X-ApiKey", "{key}"), True),
    "wos_expanded": Endpoint(WOS_URL, "usrQuery", {"databaseId": "WOS"}, 1.1, {"Accept": "application/json"}, "wos_expanded_key", ("X-ApiKey", "{key}"), True),
    "hal": Endpoint("https://api.archives-ouvertes.fr/search/tel", "q", {"fl": "docid,title_s,authFullName_s,producedDate_s,uri_s,abstract_s,language_s,doiId_s", "rows": 100, "wt": "json"}, 0.5),
    "theses_fr": Endpoint("https://theses.fr/api/v1/theses/recherche/", "q", {"nombre": 100, "debut": 0}, 0.5),
    "base": Endpoint("https://api.base-search.net/cgi-bin/BaseHttpSearchInterface.fcgi", "query", {"func": "PerformSearch", "hits": 100, "format": "xml"}, 0.5, key="base_key", key_header=("Authorization", "{key}"), needs_key=True, page="xml"),
    "bdtd": Endpoint("https://bdtd.ibict.br/vufind/Search/Results", "lookfor", {"type": "AllFields", "limit": 50}, 1.0, BROWSER, page="html"),
    "scielo": Endpoint("https://search.scielo.org/", "q", {"output": "site", "count": 100}, 1.0, BROWSER, page="html"),
    "europepmc": Endpoint("https://www.ebi.ac.uk/europepmc/webservices/rest/search", "query", {"format": "json", "pageSize": 100, "resultType": "core"}, 0.3),
    "eartharxiv": Endpoint("https://api.crossref.org/works", "query", {"filter": "prefix:10.31223,type:posted-content", "rows": 50, "select": CROSSREF_FIELDS}, 0.3, POLITE),
    "crossref": Endpoint("https://api.crossref.org/works", "query", {"rows": 50, "select": CROSSREF_FIELDS}, 0.3, POLITE),
    "core": Endpoint("https://api.core.ac.uk/v3/search/works/", "q", {"limit": 50}, 0.4, key="core_key", key_header=("Authorization", "Bearer {key}")),
}


class Failed(Exception):
    """A request or reply that gives no payload."""


def _get(end: Endpoint, text: str, options: dict, opener: Callable, **more) -> str:
    fill = lambda s, **kw: s.format(email=options.get("email", EMAIL), **kw) if isinstance(s, str) and "{" in s else s
    key = options.get(end.key) if end.key else None
    headers = {k: fill(v) for k, v in end.headers.items()}
    if key and end.key_header:
        headers[end.key_header[0]] = end.key_header[1].format(key=key)
    params = {k: fill(v) for k, v in end.fixed.items()} | {end.query: text} | more
    url = json.loads(options.get("address", "{}")).get(source_of(end), end.url)
    body, reason = ask(url, params, headers, end.keyed_pause if key and end.keyed_pause else end.pause, opener=opener)
    if body is None:
        raise Failed(f"status={reason}" + (f" first={more['firstRecord']}" if "firstRecord" in more else ""))
    return body


def source_of(end: Endpoint) -> str:
    return next(s for s, e in ENDPOINTS.items() if e is end)


def _parsed(body: str):
    try:
        return json.loads(body)
    except ValueError as e:
        raise Failed(f"json={e}") from None


def _cursor_pages(end, text, options, opener, cap) -> Iterator[tuple[str, list]]:
    cursor, seen = "*", 0
    while cursor and seen < cap:
        got = _parsed(_get(end, text, options, opener, cursor=cursor))
        records = got.get("results") or []
        yield text, records
        seen, cursor = seen + len(records), (got.get("meta") or {}).get("next_cursor") if records else None


def _numbered_pages(end, text, options, opener, cap) -> Iterator[tuple[str, list]]:
    first, total = 1, cap
    while first <= min(total, cap):
        want = min(100, cap + 1 - first)
        got = _parsed(_get(end, text, options, opener, count=want, firstRecord=first))
        records = got
        for step in ("Data", "Records", "records", "REC"):
            records = records.get(step) if isinstance(records, dict) else None
        records = [records] if isinstance(records, dict) else records if isinstance(records, list) else []
        yield f"{text}__p{first}", records
        found = (got.get("QueryResult") or {}).get("RecordsFound")
        total = total if found is None else int(found)
        if len(records) < want:
            break
        first += len(records)


#: Sources whose pages are followed, and how their records make one payload again.
PAGED = {
    "openalex": (_cursor_pages, lambda records: {"results": records}),
    "wos_expanded": (_numbered_pages, lambda records: {"Data": {"Records": {"records": {"REC": records}}}}),
}


def harvest_query(source: str, text: str, options: dict, opener: Callable = urllib.request.urlopen, keep: Callable[[str, str], None] | None = None) -> tuple[str | None, str | None]:
    """(payload, error) of one query, all its pages together; ``keep(query, payload)`` gets each page.

    A failure after the first page keeps what came before, and says so.  A source that needs a key
    and has none is not asked.
    """
    end, cap = ENDPOINTS[source], int(options.get("per_query_cap", QUERY_CAP))
    if end.needs_key and not options.get(end.key):
        return None, None
    if source == "europepmc" and options.get("only_preprints", "true") == "true":
        text = f"({text}) AND SRC:PPR"
    keep = keep or (lambda query, payload: None)
    if source not in PAGED:
        try:
            body = _get(end, text, options, opener)
            payload = json.dumps({end.page: body}, ensure_ascii=False) if end.page != "json" else json.dumps(_parsed(body), ensure_ascii=False)
        except Failed as e:
            return None, str(e)
        keep(text, payload)
        return payload, None
    pages, whole = PAGED[source]
    records, error, any_page = [], None, False
    try:
        for name, got in pages(end, text, options, opener, cap):
            records, any_page = records + got, True
            if name != text:
                keep(name, json.dumps(whole(got), ensure_ascii=False))
    except Failed as e:
        error = str(e)
    payload = json.dumps(whole(records), ensure_ascii=False) if any_page else None
    if payload and source == "openalex":
        keep(text, payload)
    return payload, error


def raw_name(source: str, query: str) -> str:
    """File name of a raw response, as ``functions.text.raw_file_name``."""
    safe = re.sub(r"[^A-Za-z0-9_.\-]+", "_", query).strip()[:60]
    return f"{source}__{safe}__{hashlib.sha1(query.encode()).hexdigest()[:10]}.json"


def service_of(source: str) -> str:
    """The host that answers a source's queries; its pause is kept over all of its sources."""
    return urllib.parse.urlsplit(ENDPOINTS[source].url).netloc


def request_schedule(queries: Mapping[str, Sequence[str]]) -> list[list[tuple[str, str]]]:
    """The (source, query) pairs of each service, in the order in which it is asked."""
    services: dict[str, list[tuple[str, str]]] = {}
    for source, texts in queries.items():
        services.setdefault(service_of(source), []).extend((source, q) for q in texts)
    return [asked for asked in services.values() if asked]


class _File(InputPartition):
    def __init__(self, source: str, query: str, path: str):
        self.source, self.query, self.path = source, query, path


class _Service(InputPartition):
    def __init__(self, asked: list[tuple[str, str]]):
        self.asked = asked


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)
        self.sources = [s.strip() for s in self.options["source"].split(",")]
        if unknown := [s for s in self.sources if s not in ENDPOINTS]:
            raise ValueError(f"unknown source {', '.join(unknown)}")

    def partitions(self):
        folder = self.options.get("archive")
        if folder:
            store, root = fs.FileSystem.from_uri(folder)
            names = sorted(f.base_name for f in store.get_file_info(fs.FileSelector(root)) if f.base_name.endswith(".json"))
            found = [_File(s, os.path.splitext(n)[0].partition("__")[2] or "(no_query)", n) for s in self.sources for n in names if n.startswith(f"{s}__")]
            return found or [_Service([])]
        queries = json.loads(self.options.get("queries", "[]"))
        queries = queries if isinstance(queries, dict) else dict.fromkeys(self.sources, queries)
        return [_Service(asked) for asked in request_schedule({s: queries.get(s, []) for s in self.sources})] or [_Service([])]

    def read(self, part):
        if isinstance(part, _File):
            store, root = fs.FileSystem.from_uri(self.options["archive"])
            with store.open_input_file(f"{root}/{part.path}") as f:
                yield (part.source, part.query, f.read().decode("utf-8", "replace"), None)
            return
        by_page = self.options.get("pages", "false") == "true"
        for source, query in part.asked:
            pages: list[tuple[str, str]] = []
            payload, error = harvest_query(source, query, self.options, keep=lambda q, p: pages.append((q, p)))  # noqa: B023
            if by_page:
                yield from ((source, q, p, None) for q, p in pages)
                payload = None
            if payload is not None or error is not None:
                yield (source, query, payload, error)


class RecordsSource(DataSource):
    """Format ``records``: options source (or several, with commas), and archive (a folder) or queries.

    Queries are a JSON list, or an object with a list for each source.  Online also: per_query_cap,
    pages, email, only_preprints, address (a JSON object: source to the address of a mirror that answers
    for it) and the keys named in ENDPOINTS.
    """

    @classmethod
    def name(cls):
        return "records"

    def schema(self):
        return "source string, query string, payload_json string, error string"

    def reader(self, schema):
        return _Reader(self.options)


def register(spark) -> None:
    spark.dataSource.register(RecordsSource)


def harvest(spark, queries: Mapping[str, Sequence[str]], options: Mapping[str, str] | None = None, raw: str | None = None) -> DataFrame:
    """Ask every source its queries, once: (source, query, payload_json, error), a row a page.

    ``raw``: a folder that gets all pages as files when everything is asked, or none of them.
    """
    register(spark)
    asked = {s: list(q) for s, q in queries.items()}
    read = spark.read.format("records").option("source", ",".join(asked)).option("queries", json.dumps(asked)).option("pages", "true")
    pages = saved(read.options(**dict(options or {})).load(), "harvested")
    if raw is not None:
        from .archive import write_raw_files

        write_raw_files(pages, raw)
    return pages


def errors(raw: DataFrame) -> DataFrame:
    """The error log of a harvest: a line ``[source]<tab>query<tab>reason`` for each query that failed."""
    return raw.where("error is not null").select(F.concat(F.lit("["), "source", F.lit("]\t"), "query", F.lit("\t"), "error").alias("value"))
