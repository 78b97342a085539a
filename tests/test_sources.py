import json

import pytest
from pyspark.sql import functions as F

from lexharbor.plans import layout, pipelines
from lexharbor.sources import archive, files, html_scan, normalize, replay

DOI = "10.1/x"
#: Source: a payload, and cells of its first record.
PAYLOADS = {
    "openalex": (
        {"results": [{"id": "https://openalex.org/W1", "doi": DOI, "display_name": "T", "publication_year": 2020, "abstract_inverted_index": {"b": [1], "a": [0]}, "authorships": [{"author": {"display_name": "A B"}}, {"author": {}}], "primary_location": {"source": {"display_name": "J"}}, "cited_by_count": 3, "open_access": {"oa_url": "u"}}]},
        dict(id="https://openalex.org/W1", title="T", publication_year=2020, abstract="a b", authors="A B", source_journal_or_publisher="J", cited_by_count=3, open_access_url="u"),
    ),
    "semantic_scholar": ({"data": [{"paperId": "p", "externalIds": {"DOI": DOI}, "title": "T", "authors": [{"name": "A"}, {"name": "B"}], "openAccessPdf": None}]}, dict(id="p", doi=DOI, authors="A; B", language=None, open_access_url=None)),
    "wos": ({"hits": [{"uid": "WOS:1", "title": {"value": "T"}, "source": {"publishYear": 2001}, "names": {"authors": [{"wosStandard": "B, A"}]}, "citations": [{"count": 4}]}]}, dict(title="T", publication_year=2001, authors="B, A", cited_by_count=4)),
    "wos_expanded": (
        {"Data": {"Records": {"records": {"REC": {"UID": "WOS:2", "static_data": {"summary": {"titles": {"title": [{"type": "source", "content": "J"}, {"type": "item", "content": "T"}]}, "pub_info": {"@pubyear": "1999"}}}}}}}},
        dict(id="WOS:2", title="T", source_journal_or_publisher="J", publication_year=1999),
    ),
    "hal": ({"response": {"docs": [{"docid": "7", "title_s": ["T", "U"], "authFullName_s": ["A", "B"], "producedDate_s": "2010-01", "language_s": ["fr"]}]}}, dict(id="hal:7", title="T", authors="A; B", publication_year=2010, language="fr", type="thesis")),
    "theses_fr": ({"theses": [{"nnt": "N1", "titrePrincipal": "T", "auteurs": [{"nom": "A"}], "dateSoutenance": "2011-02-03"}]}, dict(id="theses_fr:N1", authors="A", publication_year=2011)),
    "europepmc": ({"resultList": {"result": [{"id": "9", "source": "PPR", "doi": DOI, "pubYear": "2022", "abstractText": "<p>x <b>y</b></p>", "pubTypeList": {"pubType": ["preprint"]}}]}}, dict(id="epmc:PPR:9", abstract="x y", type="preprint", open_access_url="https://doi.org/" + DOI, source_journal_or_publisher="Europe PMC")),
    "eartharxiv": ({"message": {"items": [{"DOI": DOI, "title": ["T"], "author": [{"family": "F", "given": "G"}, {"family": "H"}], "published": {"date-parts": [[2018, 2]]}}]}}, dict(id="eartharxiv:" + DOI, authors="F, G; H", publication_year=2018, type="preprint", source_journal_or_publisher="EarthArXiv")),
    "crossref": ({"message": {"items": [{"title": ["T" * 90], "container-title": ["J"], "URL": "u"}]}}, dict(id="crossref:" + "T" * 80, source_journal_or_publisher="J", open_access_url="u")),
    "core": ({"results": [{"id": 5, "title": "T", "authors": [{"name": "A"}] * 26, "language": {"code": "en"}}, {"id": 6}]}, dict(id="core:5", authors="", language="en", source_journal_or_publisher="CORE")),
}


@pytest.mark.parametrize("source", sorted(PAYLOADS))
def test_json_normalizers(spark, source):
    payload, want = PAYLOADS[source]
    raw = spark.createDataFrame([(source, "q", json.dumps(payload)), (source, "bad", "{"), ("other", "q", "{}")], "source string, query string, payload_json string")
    rows = normalize.normalize(raw, source).collect()
    assert len(rows) == 1
    assert {k: rows[0][k] for k in want} == want
    assert rows[0]["source_database"] == source and rows[0]["raw"]


def test_page_sources(spark):
    base = "<r><doc><dctitle>T</dctitle><dccreator>A</dccreator><dccreator>B</dccreator><dcdate>2001-2</dcdate><dclink>u</dclink></doc></r>"
    bdtd = '<div class="result"><h3><a class="title" href="/R/1">T one</a></h3><span class="author">A <b>B</b></span><i class="date">em 2015</i></div><div class="result"><p>no title</p></div>'
    scielo = '<div class="item" id="S1-mex"><strong class="title">T</strong><a href="http://x/sci_arttext?p=1">x</a><div class="line authors">A; B</div><div class="line">Revista, Dic 2024 Vol 63</div></div><div class="item"></div>'
    raw = spark.createDataFrame([("base", "q", json.dumps({"xml": base})), ("bdtd", "q", json.dumps({"html": bdtd})), ("scielo", "q", scielo)], "source string, query string, payload_json string")
    b, d, s = (normalize.normalize(raw, x).collect() for x in ("base", "bdtd", "scielo"))
    assert [(r["id"], r["authors"], r["publication_year"]) for r in b] == [("base:u", "A; B", 2001)]
    assert [(r["id"], r["authors"], r["publication_year"], r["source_journal_or_publisher"]) for r in d] == [("bdtd:https://bdtd.ibict.br/R/1", "A B", 2015, "BDTD")]
    assert [(r["id"], r["language"], r["publication_year"]) for r in s] == [("scielo:S1-mex", "es", 2024)]
    assert html_scan.parse_base("<broken") == []


def test_harvest_and_sources(spark):
    raw = spark.createDataFrame([(s, "q", json.dumps(p)) for s, (p, _) in PAYLOADS.items()], "source string, query string, payload_json string")
    out = pipelines.harvest(raw, sorted(PAYLOADS), {"v": {"t": ["T"]}}).collect()
    assert len({r["id"] for r in out}) == len(out) > 3
    assert any("|" in r["source_databases"] for r in out)  # one DOI from several sources
    with pytest.raises(ValueError):
        normalize.resolve_sources("nope", PAYLOADS)
    assert normalize.resolve_sources("hal, core", PAYLOADS) == ["hal", "core"]


TAGGED = "FN Export\nVR 1.0\nPT J\nAU Doe, J\n   Roe, R\nTI A title\n   goes on\nXX skip\n   dropped\nPY 2001\nTC x\nUT WOS:1\nER\n\nPT B\nTI Das Buch der Form\nDI 10.1/b\nER\n\nPT J\nTI No end\nUT WOS:3\n"


def test_tagged_text(spark, tmp_path):
    p = tmp_path / "x.txt"
    p.write_text(TAGGED)
    rows = files.tagged_to_records(files.tagged_records(spark, str(p))).orderBy("ord").collect()
    assert [(r["id"], r["title"], r["type"], r["publication_year"], r["cited_by_count"]) for r in rows] == [
        ("wos:WOS:1", "A title goes on", "article", 2001, None), ("wos:None", "Das Buch der Form", "book", None, None), ("wos:WOS:3", "No end", "article", None, None),
    ]
    assert rows[0]["authors"] == "Doe, J; Roe, R" and rows[1]["language"] == "de"
    out = pipelines.screen_export(spark, str(p), {"v": {"form": ["form"]}}, "v", "form").collect()
    assert {r["relevance"] for r in out} == {"form_only", "off_topic"}


def test_bibtex_round_trip(spark, tmp_path):
    cells = [(i, "Doe, J; Roe, R", 2001, 2001, "A {t}", "article", "10.1/" + str(i), "a|b", "J", "", "en") for i in range(3)]
    df = spark.createDataFrame(cells, "ord long, authors string, year int, publication_year int, title string, type string, doi string, source_databases string, source_journal_or_publisher string, open_access_url string, language string")
    archive.write_bibtex(df, str(tmp_path / "b"))
    back = files.bib_notes(spark, str(tmp_path / "b")).collect()
    assert {r["doi"]: r["note"] for r in back} == {f"10.1/{i}": "a|b" for i in range(3)}
    text = "".join(p.read_text() for p in sorted((tmp_path / "b").glob("part-*")))
    assert [x for x in ("{doe2001a,", "{doe2001aa,", "{doe2001ab,") if x in text] == ["{doe2001a,", "{doe2001aa,", "{doe2001ab,"]
    assert "author = {Doe, J and Roe, R}" in text and r"title = {A \{t\}}" in text and "url" not in text


def test_bibtex_last_note_wins(spark, tmp_path):
    (tmp_path / "x.bib").write_text("@article{a,\n  doi = {10.1/x},\n  note = {one}\n}\n\n@article{b,\n  doi = {doi:10.1/X},\n  note = {two},\n}\n@article{c,\n  doi = {10.1/y}\n}\n")
    assert [tuple(r) for r in files.bib_notes(spark, str(tmp_path / "x.bib")).collect()] == [("10.1/x", "two")]


def test_suffix_clashes_are_replayed(spark):
    from lexharbor.functions.bibtex import with_keys

    titles = ["en", "en", "ena", "en"]
    df = spark.createDataFrame([(i, "Doe, J", 2001, 2001, t) for i, t in enumerate(titles)], "ord long, authors string, year int, publication_year int, title string")
    assert [r[0] for r in with_keys(df, "ord").orderBy("ord").select("bib_key").collect()] == ["doe2001en", "doe2001ena", "doe2001enaa", "doe2001enb"]


def test_raw_folder_archive_and_cache(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    (d / "openalex__q1.json").write_text(json.dumps([{"id": "https://openalex.org/W1", "abstract_inverted_index": {"x": [0]}}]))
    (d / "semantic_scholar__q.json").write_text(json.dumps({"data": [{"paperId": "p", "abstract": " y "}]}))
    (d / "plain.json").write_text("{")
    raw = files.raw_folder(spark, str(d))
    assert {(r["source"], r["query"]) for r in raw.collect()} == {("openalex", "q1"), ("semantic_scholar", "q"), ("plain", "(no_query)")}
    assert {r["key"]: r["text"] for r in files.cached_abstracts(raw).collect()} == {"W1": "x", "p": "y"}
    back = archive.archive_verified(raw, str(tmp_path / "a"))
    assert back.count() == 3 and any(p.name.endswith("zstd.parquet") for p in (tmp_path / "a").iterdir())
    replay.register(spark)
    got = spark.read.format("records").option("source", "openalex").option("archive", str(d)).load().collect()
    assert [(r["source"], r["query"]) for r in got] == [("openalex", "q1")]


def test_csv_lists_and_globs(spark, tmp_path):
    df = spark.createDataFrame([("10.1/A", 'say "hi"\nthere'), ("", "x"), (None, "NA")], "doi string, t string")
    archive.write_csv(df, str(tmp_path / "c.csv"))
    assert [r["doi"] for r in files.corpus_dois(spark, str(tmp_path / "c.csv")).collect()] == ["10.1/a"]
    assert {r["t"] for r in archive.read_csv(spark, str(tmp_path / "c.csv"), df.schema).collect()} == {'say "hi"\nthere', "x", "NA"}
    (tmp_path / "l.txt").write_text(" 10.1/B \n\n10.1/b\n")
    assert [r[0] for r in files.list_file(spark, str(tmp_path / "l.txt")).collect()] == ["10.1/b"]
    with pytest.raises(ValueError):
        files.only_match(["a", "b"], "csv")
    assert files.only_match(["a"], "csv") == "a"


def test_layout_plan(spark):
    names = ["run.log", "x_bibliography.csv", "x_bibliography.csv.bak", "pilot1_labeled.csv", "wos_gap_labeled.csv", "wos_gap.csv", "gap_matrix_1.csv", "a.png", "keep.txt", "v.embeddings.npy"]
    got = {r[0]: r[1] for r in layout.plan_moves(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert got == {
        "run.log": "logs/run.log", "x_bibliography.csv.bak": "archive/x_bibliography.csv.bak", "pilot1_labeled.csv": "pilots/pilot1_labeled.csv", "wos_gap_labeled.csv": "gapfills/wos_gap/labeled.csv",
        "wos_gap.csv": "gapfills/wos_gap/records.csv", "gap_matrix_1.csv": "analysis/gap_matrix_1.csv", "a.png": "analysis/a.png",
    }
    with pytest.raises(ValueError):
        layout.plan_moves(spark.createDataFrame([("w_gap.csv",), ("w_gap_records.csv",)], "name string"))


def test_expression_errors_do_not_stop_a_harvest(spark):
    raw = spark.createDataFrame([("core", "q", '{"results": [{"title": "T", "yearPublished": "x", "authors": "none"}]}')], "source string, query string, payload_json string")
    assert normalize.normalize(raw, "core").select(F.col("publication_year")).collect()[0][0] is None


def test_many_repeats_of_a_key(spark):
    from lexharbor.functions.bibtex import with_keys

    df = spark.range(300).selectExpr("id as ord", "'Doe, J' as authors", "2001 as year", "2001 as publication_year", "'x' as title")
    got = {r[0]: r[1] for r in with_keys(df, "ord").select("ord", "bib_key").collect()}
    assert got[0] == "doe2001x" and got[1] == "doe2001xa" and got[27] == "doe2001x{" and got[299] == "doe2001x" + chr(96 + 299)


def test_harvest_order_follows_sources_queries_and_places(spark):
    page = lambda *ids: json.dumps({"results": [{"id": i, "display_name": i} for i in ids]})
    raw = spark.createDataFrame([("openalex", "b", page("2", "1")), ("openalex", "a", page("3", "2")), ("core", "x", '{"results": [{"id": 9, "title": "T"}]}')], "source string, query string, payload_json string")
    in_order = lambda df: [r["id"] for r in df.orderBy("ord").collect()]
    assert in_order(normalize.harvest(raw, ["openalex", "core"])) == ["3", "2", "1", "core:9"]
    assert in_order(normalize.harvest(raw, ["core", "openalex"], ["b", "a"])) == ["core:9", "2", "1", "3"]


def test_files_without_a_record_are_no_error(spark, tmp_path):
    """The end of an export may be a split of its own, as large exports are read in several."""
    for name, text in (("a", "PT J\nUT WOS:1\nAU A\n   B\nER\n"), ("b", "\nEF\n"), ("c", "\n")):
        (tmp_path / name).write_text(text)
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a task for each file
    try:
        for paths, want in (([str(tmp_path)], ["wos:WOS:1"]), ([str(tmp_path / "b")], [])):
            assert [r["id"] for r in files.tagged_to_records(files.tagged_records(spark, *paths)).collect()] == want
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
