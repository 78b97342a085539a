"""A query for each source: records as its payloads, read back by its normaliser; and scalar functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html, nested, text
from ..sources import files, normalize
from . import records as R
from .queries import query

OUT = ("id", "doi", "title", "publication_year", "language", "type", "abstract", "authors", "source_journal_or_publisher", "cited_by_count", "open_access_url")
c = F.col


def _obj(**fields) -> Column:
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()])


def _read_back(spark, sf, source: str, payload: Column) -> DataFrame:
    """A payload for each record, normalised."""
    rows = R.records(spark, sf).select(F.lit(source).alias("source"), F.concat(F.lit("q"), "ord").alias("query"), payload.alias("payload_json"))
    return normalize.normalize(rows, source).select(*OUT)


def _expect(**cells: str) -> str:
    """DuckDB text of what a source's records are, from the record view."""
    base = {
        "id": "id", "doi": "doi", "title": "nullif(title, '')", "publication_year": "publication_year", "language": "language", "type": "type", "abstract": "nullif(abstract, '')",
        "authors": "'A B; C' || ord", "source_journal_or_publisher": "'Journal'", "cited_by_count": "cited_by_count", "open_access_url": "open_access_url",
    }
    return f"WITH {R.REC} SELECT " + ", ".join(f"{v} AS {k}" for k, v in (base | cells).items()) + " FROM rec"


_NULL, _NULL_INT = "CAST(NULL AS VARCHAR)", "CAST(NULL AS INTEGER)"
_people = lambda key: F.array(_obj(**{key: "A B"}), _obj(**{key: F.concat(F.lit("C"), c("ord"))}))
_year_date = lambda: F.concat(c("publication_year").cast("string"), F.lit("-05-01"))  # noqa: E731  (columns need a session)
_URL_OR_DOI = "COALESCE(open_access_url, 'https://doi.org/' || doi)"


@query(_expect(abstract="'a b a'"))
def source_openalex(spark, sf):
    work = _obj(
        id=c("id"), doi=c("doi"), display_name=c("title"), publication_year=c("publication_year"), language=c("language"), type=c("type"),
        abstract_inverted_index=F.create_map(F.lit("b"), F.array(F.lit(1)), F.lit("a"), F.array(F.lit(0), F.lit(2))),
        authorships=F.array(_obj(author=_obj(display_name="A B")), _obj(author=_obj(display_name=F.concat(F.lit("C"), c("ord")))), _obj(author=_obj(display_name=F.lit(None).cast("string")))),
        primary_location=_obj(source=_obj(display_name="Journal")), cited_by_count=c("cited_by_count"), open_access=_obj(oa_url=c("open_access_url")),
    )
    return _read_back(spark, sf, "openalex", F.to_json(_obj(results=F.array(work))))


@query(_expect(title="title", abstract="abstract", language=_NULL, type=_NULL))
def source_semantic_scholar(spark, sf):
    paper = _obj(
        paperId=c("id"), externalIds=_obj(DOI=c("doi")), title=c("title"), year=c("publication_year"), abstract=c("abstract"), authors=_people("name"),
        venue="Journal", citationCount=c("cited_by_count"), openAccessPdf=_obj(url=c("open_access_url")),
    )
    return _read_back(spark, sf, "semantic_scholar", F.to_json(_obj(data=F.array(paper))))


@query(_expect(title="title", language=_NULL, abstract=_NULL, open_access_url=_NULL))
def source_wos(spark, sf):
    hit = _obj(
        uid=c("id"), identifiers=_obj(doi=c("doi")), title=_obj(value=c("title")), source=_obj(publishYear=c("publication_year"), sourceTitle="Journal"), documentType=c("type"),
        names=_obj(authors=F.array(_obj(displayName="A B", wosStandard=F.lit(None).cast("string")), _obj(displayName=F.lit(None).cast("string"), wosStandard=F.concat(F.lit("C"), c("ord"))))),
        citations=F.array(_obj(count=c("cited_by_count"))),
    )
    return _read_back(spark, sf, "wos", F.to_json(_obj(hits=F.array(hit))))


@query(_expect(title="title", type="'Article'", abstract="'one two'", open_access_url=_NULL))
def source_wos_expanded(spark, sf):
    titles = F.array(_obj(type="source", content="Journal"), _obj(type="item", content=c("title")))
    rec = _obj(
        UID=c("id"),
        static_data=_obj(
            summary=_obj(titles=_obj(title=titles), names=_obj(name=_people("display_name")), pub_info=_obj(pubyear=c("publication_year")), doctypes=_obj(doctype=F.array(F.lit("Article")))),
            fullrecord_metadata=_obj(languages=_obj(language=_obj(content=c("language"))), abstracts=_obj(abstract=_obj(abstract_text=_obj(p=F.array(F.lit("one"), F.lit("two")))))),
        ),
        dynamic_data=_obj(cluster_related=_obj(identifiers=_obj(identifier=F.array(_obj(type="doi", value=c("doi"))))), citation_related=_obj(tc_list=_obj(silo_tc=_obj(local_count=c("cited_by_count"))))),
    )
    # A single record is an object, not a list.
    return _read_back(spark, sf, "wos_expanded", F.to_json(_obj(Data=_obj(Records=_obj(records=_obj(REC=rec))))))


@query(_expect(id="'hal:' || ord", title="title", abstract="abstract", type="'thesis'", source_journal_or_publisher="'HAL/TEL'", cited_by_count=_NULL_INT))
def source_hal(spark, sf):
    doc = _obj(
        docid=c("ord").cast("string"), title_s=F.array(c("title"), F.lit("second")), authFullName_s=F.array(F.lit("A B"), F.concat(F.lit("C"), c("ord"))), producedDate_s=_year_date(),
        uri_s=c("open_access_url"), abstract_s=F.array(c("abstract")), language_s=F.when(c("language").isNotNull(), F.array(c("language"))), doiId_s=c("doi"),
    )
    return _read_back(spark, sf, "hal", F.to_json(_obj(response=_obj(docs=F.array(doc)))))


@query(_expect(id="'theses_fr:' || ord", doi=_NULL, abstract="abstract", type="'thesis'", cited_by_count=_NULL_INT))
def source_theses_fr(spark, sf):
    even = c("ord") % 2 == 0  # two shapes of a reply
    shown = lambda cond, v: F.when(cond, v)
    one = _obj(
        id=shown(even, c("ord").cast("string")), nnt=shown(~even, c("ord").cast("string")), titrePrincipal=shown(even, c("title")), titre=c("title"), auteurs=_people("nom"),
        dateSoutenance=shown(even, _year_date()), annee=c("publication_year").cast("string"), langue=c("language"), resume=c("abstract"),
        etablissementSoutenance=shown(even, F.lit("Journal")), etablissement="Journal", accessibleEnLigne=c("open_access_url"),
    )
    return _read_back(spark, sf, "theses_fr", F.when(even, F.to_json(_obj(theses=F.array(one)))).otherwise(F.to_json(_obj(results=F.array(one)))))


@query(_expect(id="'epmc:PPR:' || ord", title="title", language=_NULL, abstract="'x y'", authors="authors", open_access_url=_URL_OR_DOI))
def source_europepmc(spark, sf):
    hit = _obj(
        id=c("ord").cast("string"), source="PPR", doi=c("doi"), title=c("title"), pubYear=c("publication_year").cast("string"), abstractText="<p>x <b>y</b></p>", authorString=c("authors"),
        journalTitle="Journal", citedByCount=c("cited_by_count"), pubTypeList=_obj(pubType=F.array(c("type"))),
        fullTextUrlList=_obj(fullTextUrl=F.when(c("open_access_url").isNotNull(), F.array(_obj(url=c("open_access_url"))))),
    )
    return _read_back(spark, sf, "europepmc", F.to_json(_obj(resultList=_obj(result=F.array(hit)))))


def _crossref_item(**more) -> Column:
    people = F.array(_obj(family="F", given="G"), _obj(family=F.concat(F.lit("H"), c("ord")), given=F.lit(None).cast("string")))
    return _obj(DOI=c("doi"), title=F.when(c("title") != "", F.array(c("title"))), author=people, published=_obj(**{"date-parts": F.array(F.array(c("publication_year"), F.lit(2)))}), abstract="<jats:p>x</jats:p>", URL=c("open_access_url"), language=c("language"), **more)


_CROSSREF = dict(abstract="'x'", authors="'F, G; H' || ord", cited_by_count=_NULL_INT, open_access_url=_URL_OR_DOI)
_crossref_id = lambda key: f"'{key}:' || COALESCE(doi, nullif(substring(title, 1, 80), ''), 'unknown')"


@query(_expect(**_CROSSREF, id=_crossref_id("eartharxiv"), type="'preprint'", source_journal_or_publisher="'EarthArXiv'"))
def source_eartharxiv(spark, sf):
    return _read_back(spark, sf, "eartharxiv", F.to_json(_obj(message=_obj(items=F.array(_crossref_item())))))


@query(_expect(**_CROSSREF, id=_crossref_id("crossref"), source_journal_or_publisher="CASE WHEN ord % 2 = 0 THEN 'Journal' ELSE 'Crossref' END"))
def source_crossref(spark, sf):
    venue = F.when(c("ord") % 2 == 0, F.array(F.lit("Journal")))
    return _read_back(spark, sf, "crossref", F.to_json(_obj(message=_obj(items=F.array(_crossref_item(**{"container-title": venue, "type": c("type")}))))))


@query(_expect(id="'core:' || ord", authors="CASE WHEN ord % 17 = 0 THEN '' ELSE 'A; A' END", open_access_url=_URL_OR_DOI) + " WHERE title <> ''")
def source_core(spark, sf):
    n = F.when(c("ord") % 17 == 0, 26).otherwise(2)  # more than 25 names are a reference list
    work = _obj(
        id=c("ord"), doi=c("doi"), title=F.nullif(c("title"), F.lit("")), yearPublished=c("publication_year"), language=_obj(code=c("language")), documentType=c("type"), abstract=c("abstract"),
        authors=F.transform(F.sequence(F.lit(1), n), lambda i: _obj(name="A")), publisher="Journal", citationCount=c("cited_by_count"),
        sourceFulltextUrls=F.when(c("open_access_url").isNotNull(), F.array(c("open_access_url"))),
    )
    return _read_back(spark, sf, "core", F.to_json(_obj(results=F.array(work))))


_n = lambda: F.col("ord").cast("string")
_PAGE = dict(doi=_NULL, title="'T ' || ord", abstract=_NULL, cited_by_count=_NULL_INT)


@query(_expect(**_PAGE, id="'base:u' || ord", type="'thesis'", authors="'A; B'", source_journal_or_publisher="'BASE'", open_access_url="'u' || ord"))
def source_base(spark, sf):
    language = F.when(c("language").isNotNull(), F.concat(F.lit("<dclang>"), c("language"), F.lit("</dclang>"))).otherwise("")
    page = F.concat(
        F.lit("<r><doc><dctitle>T "), _n(), F.lit("</dctitle><dccreator>A</dccreator><dccreator>B</dccreator><dcyear>"), c("publication_year"), F.lit("</dcyear><dclink>u"), _n(),
        F.lit("</dclink><dctype>thesis</dctype>"), language, F.lit("</doc></r>"),
    )
    return _read_back(spark, sf, "base", F.to_json(_obj(xml=page)))


@query(_expect(**_PAGE, id="'bdtd:https://bdtd.ibict.br/R/' || ord", language="'pt'", type="'thesis'", authors="'A B'", source_journal_or_publisher="'BDTD'", open_access_url="'https://bdtd.ibict.br/R/' || ord"))
def source_bdtd(spark, sf):
    page = F.concat(F.lit('<div class="result"><h3><a class="title" href="/R/'), _n(), F.lit('">T '), _n(), F.lit('</a></h3><span class="author">A <b>B</b></span><i class="date">em '), c("publication_year"), F.lit('</i></div><div class="result"><p>none</p></div>'))
    return _read_back(spark, sf, "bdtd", F.to_json(_obj(html=page)))


@query(_expect(**_PAGE, id="'scielo:S' || ord || CASE WHEN ord % 2 = 0 THEN '-mex' ELSE '-bra' END", language="CASE WHEN ord % 2 = 0 THEN 'es' ELSE 'pt' END", type="'article'", authors="'A; B'", source_journal_or_publisher="'Revista X, Dic ' || publication_year || ' Vol 3'", open_access_url="'http://x/sci_arttext?p=' || ord"))
def source_scielo(spark, sf):
    page = F.concat(
        F.lit('<div class="item" id="S'), _n(), F.when(c("ord") % 2 == 0, "-mex").otherwise("-bra"), F.lit('"><strong class="title">T '), _n(), F.lit('</strong><a href="http://x/sci_arttext?p='), _n(),
        F.lit('">x</a><div class="line authors">A; B</div><div class="line">Revista X, Dic '), c("publication_year"), F.lit(" Vol 3</div></div>"),
    )
    return _read_back(spark, sf, "scielo", F.to_json(_obj(html=page)))


# ------------------------------------------------------------------ scalar functions without a query of their own
@query(f"WITH {R.REC} SELECT ord, 'a & <b> é ' || ord AS decoded, 'Fish & ' || ord AS plain FROM rec")
def unescape_entities(spark, sf):
    coded = F.concat(F.lit("a &amp; &lt;b&gt; &eacute; "), c("ord"))
    return R.records(spark, sf).select("ord", html.unescape(coded).alias("decoded"), html.strip_tags_unescape(F.concat(F.lit("<i>Fish</i> &amp; <b>"), c("ord"), F.lit("</b>"))).alias("plain"))


@query(f"WITH {R.REC} SELECT ord, CASE ord % 3 WHEN 0 THEN 'W' || ord WHEN 1 THEN 'WOS:' || ord ELSE '' END AS native, CASE WHEN ord % 2 = 0 THEN lower(doi) END AS text, CASE WHEN ord % 4 < 3 THEN ord % 4 END AS number FROM rec")
def coercions(spark, sf):
    """Native identifiers, cells that mean nothing, and numbers in text."""
    key = F.when(c("ord") % 3 == 0, F.concat(F.lit(" https://openalex.org/W"), c("ord"))).when(c("ord") % 3 == 1, F.concat(F.lit("WOS:"), c("ord"), F.lit(" ")))
    cell = F.when(c("ord") % 2 == 0, F.concat(F.lit(" "), F.lower("doi"), F.lit("\t"))).when(c("ord") % 3 == 0, " nan").otherwise("")
    number = F.when(c("ord") % 4 < 3, (c("ord") % 4).cast("string")).when(c("ord") % 8 == 3, "x3").otherwise("")
    return R.records(spark, sf).select("ord", text.native_id(key).alias("native"), text.blank_to_null(cell).alias("text"), nested.safe_int(number).cast("long").alias("number"))


@query(f"WITH {R.REC}, f AS (SELECT ord, string_split(COALESCE(title, ''), '. ')[1] AS s FROM rec) SELECT ord, CASE WHEN length(s) > 60 THEN substring(s, 1, 59) || '…' ELSE s END AS label FROM f")
def short_labels(spark, sf):
    return R.records(spark, sf).select("ord", text.short_label(F.coalesce("title", F.lit(""))).alias("label"))


@query(f"WITH {R.REC} SELECT ord, 'crossref__' || substring('q_' || ord || '_' || repeat('x', 70), 1, 60) || '__' || substring(sha1('q é/' || ord || ' ' || repeat('x', 70)), 1, 10) || '.json' AS name FROM rec")
def raw_file_names(spark, sf):
    asked = F.concat(F.lit("q é/"), c("ord"), F.lit(" " + "x" * 70))
    return R.records(spark, sf).select("ord", text.raw_file_name(F.lit("crossref"), asked).alias("name"))


@query(f"WITH {R.REC} SELECT ord, publication_year AS prefix, CASE WHEN ord % 2 = 0 THEN publication_year END AS token, CASE WHEN publication_year BETWEEN 2000 AND 2010 THEN publication_year END AS within FROM rec")
def year_texts(spark, sf):
    y = c("publication_year").cast("string")
    said = F.when(c("ord") % 2 == 0, F.concat(F.lit("em 12345 "), y, F.lit(" 1066"))).otherwise(F.concat(F.lit("x"), y))
    return R.records(spark, sf).select("ord", text.year_prefix(F.concat(y, F.lit("-05"))).alias("prefix"), text.year_token(said).alias("token"), text.year_token(F.concat(F.lit("9999 "), y), 2000, 2010).alias("within"))


@query(
    f"WITH {R.REC} SELECT ord, CAST(2000 + ord % 9 AS INTEGER) AS issued, CASE WHEN ord % 2 = 0 THEN 'F, G; H' ELSE '' END AS names, "
    "CASE ord % 3 WHEN 0 THEN 'first' WHEN 1 THEN 'one' END AS any_of, CASE ord % 3 WHEN 2 THEN NULL ELSE 'x' || ord END AS alternative FROM rec"
)
def nested_helpers(spark, sf):
    """Date parts, names, first elements and alternative keys of nested replies."""
    three = c("ord") % 3
    doc = F.to_json(_obj(
        issued=_obj(**{"date-parts": F.array(F.array(F.lit(2000) + (c("ord") % 9).cast("int")))}),
        author=F.when(c("ord") % 2 == 0, F.array(_obj(family="F", given="G"), _obj(family="H", given=F.lit(None).cast("string")))),
        many=F.when(three == 0, F.array(F.lit("first"), F.lit("second"))), one=F.when(three == 1, F.lit("one")),
        late=F.when(three == 1, F.array(F.concat(F.lit(" x"), c("ord")))), early=F.when(three == 0, F.concat(F.lit("x"), c("ord"), F.lit(" "))),
    ))
    v = c("v")
    rows = R.records(spark, sf).select("ord", nested.variant(doc).alias("v"))
    return rows.select(
        "ord", nested.date_parts_year(v, "issued").alias("issued"), nested.family_given(nested.as_list(v, "author")).alias("names"),
        F.coalesce(nested.path(nested.first(v, "many"), ""), nested.path(nested.first(v, "one"), "")).alias("any_of"), nested.alternatives(v, "early", "late").alias("alternative"),
    )


@query(
    f"WITH {R.REC} SELECT CASE ord % 5 WHEN 0 THEN 'W' || ord WHEN 1 THEN 'WOS:' || ord WHEN 2 THEN 'p' || ord WHEN 3 THEN 'hal:h' || ord ELSE 'http://b/' || ord END AS key, "
    "CASE ord % 5 WHEN 0 THEN 'a b' WHEN 1 THEN 'one two' ELSE 'text ' || ord END AS text FROM rec"
)
def cached_abstracts(spark, sf):
    """Abstracts of cached replies under their sources' own identifiers; a second reply of a record changes nothing."""
    five, no = c("ord") % 5, F.lit(None).cast("string")
    said = F.concat(F.lit("text "), c("ord"))
    payloads = [
        ("openalex", _obj(results=F.array(_obj(id=F.concat(F.lit("https://openalex.org/W"), c("ord")), abstract_inverted_index=F.create_map(F.lit("b"), F.array(F.lit(1)), F.lit("a"), F.array(F.lit(0))))))),
        ("wos_expanded", _obj(Data=_obj(Records=_obj(records=_obj(REC=_obj(UID=F.concat(F.lit("WOS:"), c("ord")), static_data=_obj(fullrecord_metadata=_obj(abstracts=_obj(abstract=_obj(abstract_text=_obj(p=F.array(F.lit("one"), F.lit("two"))))))))))))),
        ("semantic_scholar", _obj(data=F.array(_obj(paperId=F.concat(F.lit("p"), c("ord")), abstract=said)))),
        ("hal", _obj(response=_obj(docs=F.array(_obj(docid="d", halId_s=F.concat(F.lit("h"), c("ord")), abstract_s=F.array(said)))))),
        ("bdtd", _obj(records=F.array(_obj(id=no, url=F.concat(F.lit("http://b/"), c("ord")), description=said)))),
    ]
    source, payload = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (name, p) in enumerate(payloads):
        source, payload = F.when(five == i, name).otherwise(source), F.when(five == i, F.to_json(p)).otherwise(payload)
    raw = R.records(spark, sf).select(source.alias("source"), F.concat(F.lit("q"), F.lpad(c("ord").cast("string"), 12, "0")).alias("query"), payload.alias("payload_json"))
    later = raw.withColumn("query", F.concat(F.lit("z"), c("query"))).withColumn("payload_json", F.replace("payload_json", F.lit("text "), F.lit("other ")))
    return files.cached_abstracts(raw.unionByName(later.where("source <> 'openalex' and source <> 'wos_expanded'")))
