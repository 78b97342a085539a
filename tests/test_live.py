"""Live sources against a fake service: pages, caps, headers, failures, raw files."""

import io
import json
import urllib.error
import urllib.parse

import pytest
from pyspark.sql import functions as F

from lexharbor.operators import resolve
from lexharbor.sources import archive, files, lookup, normalize, replay


@pytest.fixture(autouse=True)
def no_waiting(monkeypatch):
    monkeypatch.setattr(lookup.time, "sleep", lambda s: None)


class Service:
    """Answers by ``reply(url, params)``: a text, or a status that is raised."""

    def __init__(self, reply):
        self.reply, self.asked = reply, []

    def __call__(self, request, timeout):
        url, _, query = request.full_url.partition("?")
        params = dict(urllib.parse.parse_qsl(query))
        self.asked.append((url, params, {k.lower(): v for k, v in request.header_items()}))
        got = self.reply(url, params)
        if isinstance(got, int):
            raise urllib.error.HTTPError(request.full_url, got, "no", {}, None)
        return io.BytesIO(got.encode())


def test_cursor_is_followed_to_the_cap():
    def reply(url, params):
        n = {"*": 0, "c1": 1, "c2": 2, "c3": 3}[params["cursor"]]
        return json.dumps({"results": [{"id": f"W{n}-{i}"} for i in range(200)], "meta": {"next_cursor": f"c{n + 1}"}})

    service, kept = Service(reply), []
    payload, error = replay.harvest_query("openalex", "soil", {"email": "a@b"}, service, lambda q, p: kept.append(q))
    assert error is None and len(json.loads(payload)["results"]) == 600 and len(service.asked) == 3 and kept == ["soil"]
    assert service.asked[0][1] == {"per_page": "200", "mailto": "a@b", "search": "soil", "cursor": "*"}
    payload, _ = replay.harvest_query("openalex", "soil", {"per_query_cap": "150"}, Service(reply))
    assert len(json.loads(payload)["results"]) == 200  # a page is finished
    last = Service(lambda u, p: json.dumps({"results": [{"id": "W"}], "meta": {"next_cursor": None}}))
    assert len(json.loads(replay.harvest_query("openalex", "q", {}, last)[0])["results"]) == 1 and len(last.asked) == 1


@pytest.mark.parametrize("found, cap, want", [(250, 500, [(1, 100), (101, 100), (201, 100)]), (900, 130, [(1, 100), (101, 30)]), (100, 500, [(1, 100)])])
def test_numbered_pages(found, cap, want):
    def reply(url, params):
        first, count = int(params["firstRecord"]), int(params["count"])
        n = min(count, found - first + 1)
        return json.dumps({"QueryResult": {"RecordsFound": found}, "Data": {"Records": {"records": {"REC": [{"UID": f"WOS:{first + i}"} for i in range(n)]}}}})

    service, kept = Service(reply), []
    payload, error = replay.harvest_query("wos_expanded", "q", {"wos_expanded_key": "k", "per_query_cap": str(cap)}, service, lambda q, p: kept.append(q))
    assert [(int(p["firstRecord"]), int(p["count"])) for _, p, _ in service.asked] == want and error is None
    assert len(json.loads(payload)["Data"]["Records"]["records"]["REC"]) == min(found, cap) and kept == [f"q__p{a}" for a, _ in want]
    assert all(u == "https://wos-api.clarivate.com/api/wos" and h["x-apikey"] == "k" for u, _, h in service.asked)


@pytest.mark.parametrize("source, options, header, value", [
    ("wos", {"wos_key": "k"}, "x-apikey", "k"), ("semantic_scholar", {"semantic_scholar_key": "k"}, "x-api-key", "k"), ("core", {"core_key": "k"}, "authorization", "Bearer k"),
    ("base", {"base_key": "k"}, "authorization", "k"), ("scielo", {}, "user-agent", replay.BROWSER["User-Agent"]), ("crossref", {"email": "a@b"}, "user-agent", "lexharbor (mailto:a@b; literature search)"),
])
def test_headers(source, options, header, value):
    service = Service(lambda u, p: "{}")
    payload, error = replay.harvest_query(source, "q", options, service)
    assert service.asked[0][2][header] == value and error is None and payload is not None
    if source == "crossref":
        assert service.asked[0][1]["select"] == replay.CROSSREF_FIELDS


def test_keys_pauses_and_failures(monkeypatch):
    waited = []
    monkeypatch.setattr(lookup.time, "sleep", waited.append)
    assert replay.harvest_query("wos", "q", {}, Service(lambda u, p: "{}")) == (None, None)  # not asked without a key
    replay.harvest_query("semantic_scholar", "q", {}, Service(lambda u, p: "{}"))
    replay.harvest_query("semantic_scholar", "q", {"semantic_scholar_key": "k"}, Service(lambda u, p: "{}"))
    assert waited == [3.5, 1.0]
    assert replay.harvest_query("hal", "q", {}, Service(lambda u, p: 403)) == (None, "status=403")
    down = Service(lambda u, p: 503)
    assert replay.harvest_query("hal", "q", {}, down) == (None, "status=503") and len(down.asked) == 4
    assert replay.harvest_query("hal", "q", {}, Service(lambda u, p: "<html>"))[1].startswith("json=")
    half = Service(lambda u, p: json.dumps({"results": [{"id": "W"}], "meta": {"next_cursor": "c"}}) if p["cursor"] == "*" else 500)
    payload, error = replay.harvest_query("openalex", "q", {}, half)
    assert len(json.loads(payload)["results"]) == 1 and error == "status=500"
    page = Service(lambda u, p: "<div>x</div>")
    assert json.loads(replay.harvest_query("bdtd", "q", {}, page)[0]) == {"html": "<div>x</div>"}
    assert replay.harvest_query("europepmc", "q", {}, (s := Service(lambda u, p: "{}"))) and s.asked[0][1]["query"] == "(q) AND SRC:PPR"


def test_pages_normalise_and_errors_are_logged(spark):
    payload, _ = replay.harvest_query("wos_expanded", "q", {"wos_expanded_key": "k"}, Service(lambda u, p: json.dumps({"QueryResult": {"RecordsFound": 1}, "Data": {"Records": {"records": {"REC": {"UID": "WOS:1"}}}}})))
    raw = spark.createDataFrame([("wos_expanded", "q", payload, None), ("wos_expanded", "r", None, "status=503 first=1")], replay.RecordsSource({}).schema())
    assert [r["id"] for r in normalize.normalize(raw, "wos_expanded").collect()] == ["WOS:1"]
    assert [r["value"] for r in replay.errors(raw).collect()] == ["[wos_expanded]\tr\tstatus=503 first=1"]


def test_raw_folder_is_removed_only_after_the_check(spark, tmp_path, monkeypatch):
    raw = spark.createDataFrame([("hal", f"q {i}", json.dumps({"n": i})) for i in range(5)], "source string, query string, payload_json string")
    folder = (tmp_path / "raw").as_uri()
    archive.write_raw_files(raw, folder)
    assert len(list((tmp_path / "raw").iterdir())) == 5
    digest = archive.content_digest
    assert digest(raw) == digest(raw.repartition(3)) != digest(raw.withColumn("query", F.lit("q")))
    seen = iter([(5, 1), (5, 2)])
    monkeypatch.setattr(archive, "content_digest", lambda df: next(seen))
    with pytest.raises(OSError):
        archive.archive_verified(files.raw_folder(spark, folder), (tmp_path / "a").as_uri(), remove=folder)
    assert (tmp_path / "raw").exists()
    monkeypatch.setattr(archive, "content_digest", digest)
    back = archive.archive_verified(files.raw_folder(spark, folder), (tmp_path / "b").as_uri(), remove=folder)
    assert back.count() == 5 and not (tmp_path / "raw").exists()


def test_rewrite_keeps_a_copy(spark, tmp_path):
    path = (tmp_path / "t").as_uri()
    write = lambda df, p: df.write.mode("overwrite").parquet(p)
    assert archive.rewrite(spark.range(3), path, write) is None
    first = archive.rewrite(spark.read.parquet(path).where("id > 0"), path, write)
    second = archive.rewrite(spark.read.parquet(path).where("id > 1"), path, write)
    assert first.endswith(".bak") and second.endswith(".bak.1")
    assert [spark.read.parquet(p).count() for p in (path, first, second)] == [1, 3, 2]


def test_resolve_without_an_order_column(spark):
    rows = [("a", "10.1/x"), ("b", "10.1/x"), ("c", None)]
    df = spark.createDataFrame([(i, d, None, "s", None, None) for i, d in rows], "id string, doi string, title string, source_database string, authors string, language string").coalesce(1)
    assert [r["id"] for r in resolve.resolve_plain(df).collect()] == ["a", "c"]
