"""Harvests of a real (local) service, its limits over many tasks, and files that are written whole or not at all."""

import json
import threading
import time
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from lexharbor.sources import archive, committed, files, lookup, normalize, replay


class Service:
    """Counts requests by path, and when they came."""

    def __init__(self, slow=0.0):
        service = self
        self.seen, self.busy, self.most, self.lock, self.slow = [], 0, 0, threading.Lock(), slow

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                path, _, query = self.path.partition("?")
                with service.lock:
                    service.busy += 1
                    service.most = max(service.most, service.busy)
                    service.seen.append((path, dict(urllib.parse.parse_qsl(query)), time.monotonic(), dict(self.headers)))
                time.sleep(service.slow)
                with service.lock:
                    service.busy -= 1
                body = json.dumps(service.reply(path, dict(urllib.parse.parse_qsl(query)))).encode()
                self.send_response(200)
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *args):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}"

    def reply(self, path, params):
        if path == "/wos_expanded":
            first, count = int(params["firstRecord"]), int(params["count"])
            n = max(0, min(count, 150 - first + 1))
            return {"QueryResult": {"RecordsFound": 150}, "Data": {"Records": {"records": {"REC": [{"UID": f"WOS:{first + i}"} for i in range(n)]}}}}
        return {"resultList": {"result": []}, "message": {"items": [{"DOI": f"10.1/{params.get('query', '')}", "title": ["T"]}]}, "response": {"docs": []}, "results": [], "data": []}


@pytest.fixture
def service():
    s = Service()
    yield s
    s.server.shutdown()


def address(service, *sources):
    return {"address": json.dumps({s: f"{service.url}/{s}" for s in sources})}


def test_the_schedule_has_a_list_for_each_service():
    asked = replay.request_schedule({"crossref": ["a", "b"], "hal": ["a"], "eartharxiv": ["c"], "core": []})
    assert asked == [[("crossref", "a"), ("crossref", "b"), ("eartharxiv", "c")], [("hal", "a")]]  # two sources, one host
    every = replay.request_schedule(dict.fromkeys(replay.ENDPOINTS, ["q"]))
    assert len(every) == 12 and sum(map(len, every)) == 13


def test_the_pause_is_kept_whatever_the_number_of_cores(spark, service):
    """Eight queries on four cores: one after another, a pause between each two."""
    replay.register(spark)
    got = spark.read.format("records").option("source", "crossref").option("queries", json.dumps([f"q{i}" for i in range(8)])).options(**address(service, "crossref")).load()
    assert got.rdd.getNumPartitions() == 1
    rows = got.collect()
    assert [r["query"] for r in rows] == [f"q{i}" for i in range(8)]
    times = [t for _, _, t, _ in service.seen]
    assert [p["query"] for _, p, _, _ in service.seen] == [f"q{i}" for i in range(8)]
    assert min(b - a for a, b in zip(times, times[1:], strict=False)) >= 0.3 and service.most == 1


def test_services_are_asked_side_by_side(spark):
    slow = Service(slow=1.0)
    names = ["europepmc", "hal", "theses_fr", "core"]
    try:
        rows = replay.harvest(spark, dict.fromkeys(names, ["x"]), address(slow, *names)).collect()
    finally:
        slow.server.shutdown()
    assert sorted(r["source"] for r in rows) == sorted(names) and all(r["error"] is None for r in rows)
    assert slow.most >= 3  # four cores


def test_lookups_ask_in_order_from_one_task(spark, tmp_path):
    log = str(tmp_path / "log")

    def fetch(keys):
        with open(log, "a") as f:
            f.write(f"{','.join(keys)}\n")
        return {k: k.upper() for k in keys if k != "k05"}

    keys = spark.createDataFrame([(f"k{i % 23:02d}",) for i in range(60)] + [(None,)], "doi string").repartition(8)
    got = {r["key"]: r["text"] for r in lookup.lookup_table(keys, "doi", fetch, batch=5).collect()}
    asked = [line.split(",") for line in open(log).read().split()]
    assert sum(asked, []) == [f"k{i:02d}" for i in range(23)] and max(map(len, asked)) == 5
    assert got == {f"k{i:02d}": f"K{i:02d}" for i in range(23) if i != 5}
    assert lookup.lookup_table(keys.limit(0), "doi", fetch).collect() == []


def test_lookups_say_who_asks(service):
    seen = []

    def opener(request, timeout):
        import io

        seen.append((request.full_url, dict(request.header_items())))
        return io.BytesIO(b"{}")

    lookup.crossref_abstracts(["10.1/x"], opener, email="a@b")
    lookup.openalex_abstracts(["10.1/X"], opener, email="a@b")
    assert seen[0][1]["User-agent"] == "lexharbor (mailto:a@b; literature search)"
    assert seen[1][0] == "https://api.openalex.org/works/doi:10.1/x?mailto=a%40b"


def test_a_harvest_keeps_its_pages_and_replays_them(spark, service, tmp_path):
    raw = (tmp_path / "raw").as_uri()
    options = address(service, "wos_expanded", "crossref") | {"wos_expanded_key": "k"}
    got = replay.harvest(spark, {"wos_expanded": ["q"], "crossref": ["soil", "rock"]}, options, raw)
    assert sorted(r["query"] for r in got.collect()) == ["q__p1", "q__p101", "rock", "soil"] and len(service.seen) == 4
    names = sorted(p.name for p in (tmp_path / "raw").iterdir())
    assert names == sorted(replay.raw_name(s, q) for s, q in [("wos_expanded", "q__p1"), ("wos_expanded", "q__p101"), ("crossref", "soil"), ("crossref", "rock")])
    back = spark.read.format("records").option("source", "wos_expanded,crossref").option("archive", raw).load()
    for source, n in (("wos_expanded", 150), ("crossref", 2)):
        ids = [sorted(r["id"] for r in normalize.normalize(df.where(F.col("source") == source), source).collect()) for df in (got, back)]
        assert ids[0] == ids[1] and len(ids[0]) == n
    assert replay.harvest(spark, {"crossref": []}).collect() == []
    with pytest.raises(Exception, match="unknown source"):
        replay.harvest(spark, {"nowhere": ["q"]}).collect()


# ------------------------------------------------------------------ committed files
def listing(path):
    return {p.name: p.read_text() for p in path.iterdir()} if path.exists() else {}


def test_files_appear_together(spark, tmp_path):
    folder = tmp_path / "out"
    rows = spark.createDataFrame([(f"f{i}", f"text é {i}") for i in range(20)] + [("empty", None)], "name string, content string").withColumn("extra", F.lit(1)).repartition(5)
    committed.write_named(rows, folder.as_uri())
    assert listing(folder) == {**{f"f{i}": f"text é {i}" for i in range(20)}, "empty": ""}
    more = spark.createDataFrame([("f3", "new"), ("g", "x")], "name string, content string")
    committed.write_named(more, folder.as_uri())
    assert len(listing(folder)) == 22 and listing(folder)["f3"] == "new"
    committed.write_named(more, folder.as_uri(), overwrite=True)
    assert listing(folder) == {"f3": "new", "g": "x"}
    committed.write_named(more.limit(0), folder.as_uri())
    assert listing(folder) == {"f3": "new", "g": "x"}


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    folder = tmp_path / "out"
    good = spark.createDataFrame([(f"f{i}", "x") for i in range(20)], "name string, content string")
    for bad in ("../up", "", "_hidden"):
        with pytest.raises(Exception):
            committed.write_named(good.unionByName(spark.createDataFrame([(bad, "x")], "name string, content string")), folder.as_uri())
        assert listing(folder) == {}
    committed.write_named(good, folder.as_uri())
    assert len(listing(folder)) == 20


def test_only_the_attempt_that_counts_is_kept(tmp_path, monkeypatch):
    """A task that stops half-way and runs again: one set of files, from the second attempt."""
    folder, rows = (tmp_path / "out"), [{"name": f"f{i}", "content": "good"} for i in range(5)]

    class Task:
        def __init__(self, partition, attempt):
            self.partitionId, self.taskAttemptId = lambda: partition, lambda: attempt

    writer = committed._Writer(folder.as_uri(), False)

    def run(partition, attempt, rows):
        monkeypatch.setattr(committed.TaskContext, "get", classmethod(lambda cls: Task(partition, attempt)))
        return writer.write(iter(rows))

    def stops():
        yield {"name": "f0", "content": "bad"}
        yield {"name": "left over", "content": "bad"}
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        run(0, 7, stops())
    done = [run(0, 8, rows), run(1, 9, [{"name": "h", "content": "x"}]), run(2, 10, [])]
    run(1, 11, [{"name": "h", "content": "twice"}])  # speculative, its message does not count
    writer.commit(done)
    assert listing(folder) == {**{f"f{i}": "good" for i in range(5)}, "h": "x"}


@pytest.mark.parametrize("moves", range(5))
def test_a_driver_that_stops_while_renaming_is_finished(spark, tmp_path, monkeypatch, moves):
    """After any number of renames the folder has old and new files; the next write makes it whole."""
    folder = tmp_path / "out"
    rows = spark.createDataFrame([(f"f{i}", "new") for i in range(4)], "name string, content string")
    committed.write_named(spark.createDataFrame([("f0", "old"), ("f9", "old")], "name string, content string"), folder.as_uri())
    store, root = committed.locate(folder.as_uri())
    staging = f"{root}/{committed.STAGING}x"
    store.create_dir(f"{staging}/0-1", recursive=True)
    for i in range(4):
        with store.open_output_stream(f"{staging}/0-1/f{i}") as f:
            f.write(b"new")
    with store.open_output_stream(f"{staging}/{committed.JOURNAL}") as f:
        f.write(json.dumps({"moves": [["0-1", f"f{i}"] for i in range(4)], "only": False}).encode())
    for i in range(moves):
        store.move(f"{staging}/0-1/f{i}", f"{root}/f{i}")
    assert committed.finish(folder.as_uri()) == 1 and committed.finish(folder.as_uri()) == 0
    assert listing(folder) == {**{f"f{i}": "new" for i in range(4)}, "f9": "old"}


def test_raw_files_are_read_back(spark, tmp_path):
    raw = spark.createDataFrame([("hal", f"q {i}", json.dumps({"n": i})) for i in range(30)] + [("hal", "none", None)], "source string, query string, payload_json string")
    folder = (tmp_path / "raw").as_uri()
    archive.write_raw_files(raw, folder)
    archive.write_raw_files(raw, folder)
    assert sorted(r["payload_json"] for r in files.raw_folder(spark, folder).collect()) == sorted(json.dumps({"n": i}) for i in range(30))
