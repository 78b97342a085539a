"""Scans of HTML and XML result pages, without a third-party parser."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..schema import RECORD

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# Collection of a record identifier -> language.
COLLECTION_LANGUAGE = {
    "bra": "pt", "scl": "pt", "prt": "pt", "cap": "pt", "mex": "es", "arg": "es", "chl": "es", "col": "es", "ven": "es", "cri": "es",
    "per": "es", "cub": "es", "ury": "es", "bol": "es", "ecu": "es", "pry": "es", "esp": "es", "sza": "en",
}


#: The collection at the end of an identifier; the links that follow a journal's name.
_COLLECTION, _PAGE_LINKS = re.compile("-[^-]*$"), re.compile(" Métricas| Sobre")


class Node:
    """An element with its attributes, children and text pieces."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.items = tag, attrs, parent, []

    def walk(self):
        for x in self.items:
            if isinstance(x, Node):
                yield x
                yield from x.walk()

    def pieces(self):
        for x in self.items:
            if isinstance(x, Node):
                yield from x.pieces()
            elif x.strip():
                yield x.strip()

    def text(self, sep: str = "") -> str:
        return sep.join(self.pieces())

    def has(self, cls: str) -> bool:
        return cls in self.attrs.get("class", "").split()

    def within(self, test) -> bool:
        up = self.parent
        while up is not None:
            if test(up):
                return True
            up = up.parent
        return False

    def first(self, test):
        return next((n for n in self.walk() if test(n)), None)


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.items.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.items.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        up = self.at
        while up is not self.root and up.tag != tag:
            up = up.parent
        if up is not self.root:
            self.at = up.parent

    def handle_data(self, data):
        self.at.items.append(data)


def tree(page: str) -> Node:
    t = _Tree()
    t.feed(page)
    t.close()
    return t.root


def _page(payload: str) -> str:
    """The page of a dumped payload: a JSON object with html or xml, or the text itself."""
    try:
        v = json.loads(payload)
    except ValueError:
        return payload
    return (v.get("html") or v.get("xml") or "") if isinstance(v, dict) else ""


def _year(tokens, low=0, high=9999):
    return next((int(t) for t in tokens if t.isdigit() and len(t) == 4 and low <= int(t) <= high), None)


def _record(source, **kw):
    return {f.name: kw.get(f.name) for f in RECORD.fields} | {"source_database": source}


def parse_base(page: str) -> list[dict]:
    out = []
    try:
        root = ElementTree.fromstring(page)
    except ElementTree.ParseError:
        return out
    for doc in root.iter("doc"):
        get = lambda *names: next(("".join(n.itertext()).strip() for name in names for n in doc.iter(name)), None)  # noqa: B023, E731
        year, url, own = get("dcyear", "dcdate") or "", get("dclink", "dcidentifier"), get("internal_id")
        out.append(_record(
            "base", id=f"base:{own if own is not None else url}", title=get("dctitle"), publication_year=int(year[:4]) if year[:4].isdigit() else None, language=get("dclang", "dclanguage"),
            type=get("dctype"), authors="; ".join("".join(n.itertext()).strip() for n in doc.iter("dccreator")), source_journal_or_publisher="BASE", open_access_url=url,
        ))
    return out


def parse_bdtd(page: str) -> list[dict]:
    out = []
    for rec in tree(page).walk():
        if not (rec.has("record") or rec.tag in ("div", "li") and rec.has("result")):
            continue
        title = rec.first(lambda n: n.tag == "a" and (n.has("title") or n.within(lambda u: u.has("title") or u.tag == "h3")))
        name = title.text() if title else ""
        if not name:
            continue
        href = title.attrs.get("href") or None
        url = f"https://bdtd.ibict.br{href}" if href and href.startswith("/") else href
        pick = lambda *cs: rec.first(lambda n: any(n.has(c) for c in cs))  # noqa: B023, E731
        author, when, inst = pick("author", "result-author"), pick("publishDate", "date", "year"), pick("institution", "publisher")
        out.append(_record(
            "bdtd", id=f"bdtd:{url or name[:80]}", title=name, publication_year=_year(when.text().split()) if when else None, language="pt", type="thesis",
            authors=author.text(" ") if author else "", source_journal_or_publisher=inst.text() if inst else "BDTD", open_access_url=url,
        ))
    return out


def parse_scielo(page: str) -> list[dict]:
    out = []
    for it in tree(page).walk():
        pid = it.attrs.get("id", "").strip()
        if it.tag != "div" or not it.has("item") or not pid:
            continue
        title = it.first(lambda n: n.tag == "strong" and n.has("title"))
        if title is None or not title.text():
            continue
        link = it.first(lambda n: n.tag == "a" and "sci_arttext" in n.attrs.get("href", ""))
        people = it.first(lambda n: n.has("authors"))
        journal = year = None
        for line in (n for n in it.walk() if n.has("line")):
            txt = line.text(" ")
            words = txt.split()
            if not journal and "," in txt and len(txt) < 200 and words and words[0].isalpha():
                journal = _PAGE_LINKS.split(txt)[0]
            year = _year(words, 1900, 2100)
            if year:
                break
        out.append(_record(
            "scielo", id=f"scielo:{pid}", title=title.text(), publication_year=year, language=COLLECTION_LANGUAGE.get((_COLLECTION.search(pid) or [""])[0].lstrip("-")), type="article",
            authors=people.text(" ") if people else "", source_journal_or_publisher=journal or "SciELO", open_access_url=link.attrs.get("href") if link else None,
        ))
    return out


def _scan(raw: DataFrame, parse) -> DataFrame:
    """Records of pages, with the query and the place on its page."""
    schema = StructType([*RECORD.fields, StructField("query", StringType()), StructField("pos", IntegerType())])

    def run(batches):
        for pdf in batches:
            rows = []
            for query, payload in zip(pdf["query"], pdf["payload_json"], strict=True):
                if isinstance(payload, str):
                    rows += [r | {"query": query, "pos": i} for i, r in enumerate(parse(_page(payload)))]
            out = pd.DataFrame(rows, columns=schema.names)
            yield out.astype({"publication_year": "Int32", "cited_by_count": "Int32", "pos": "Int32"})

    return raw.select("query", "payload_json").mapInPandas(run, schema)


def base_records(raw: DataFrame) -> DataFrame:
    return _scan(raw, parse_base)


def bdtd_records(raw: DataFrame) -> DataFrame:
    return _scan(raw, parse_bdtd)


def scielo_records(raw: DataFrame) -> DataFrame:
    return _scan(raw, parse_scielo)
