import io
import json
import urllib.error

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexharbor.backends import BackendError, make_backend
from lexharbor.backends.embed import EMBED_BACKENDS, OllamaEmbed
from lexharbor.backends.label import LABEL_BACKENDS, GatewayLabel, OllamaLabel
from lexharbor.operators import citations, labels, reports, vectors
from lexharbor.plans import pipelines
from lexharbor.sources.lookup import lookup_table, request
from lexharbor.streaming.ingest import incremental


def replies(*bodies):
    """An opener that answers with the bodies in turn; exceptions are raised."""
    left = list(bodies)

    def opener(req, timeout=None):
        x = left.pop(0)
        if isinstance(x, Exception):
            raise x
        return io.BytesIO(json.dumps(x).encode())

    return opener


def http(code):
    return urllib.error.HTTPError("u", code, "m", {}, None)


def test_registries():
    for registry in (EMBED_BACKENDS, LABEL_BACKENDS):
        with pytest.raises(ValueError, match="known are"):
            make_backend(registry, "nope")
    assert make_backend(EMBED_BACKENDS, "hashing", size=8, unknown=1).size == 8


def test_embedding_replies():
    m = OllamaEmbed(opener=replies({"embeddings": [[3, 4], [0, 5]]})).embed(["a", "b"])
    assert np.allclose(m, [[0.6, 0.8], [0, 1]])
    assert not np.isnan(OllamaEmbed(opener=replies({"embeddings": [[0, 0]]})).embed(["a"])).any()
    with pytest.raises(RuntimeError):
        OllamaEmbed(opener=replies({"embeddings": [[1]]}), max_retries=1).embed(["a", "b"])


@pytest.mark.parametrize("content", ['{"x": 1}', '```json\n{"x": 1}\n```'])
def test_label_replies(content):
    assert GatewayLabel(api_key="k", opener=replies({"choices": [{"message": {"content": content}}]})).call("p", "s") == {"x": 1}
    assert OllamaLabel(opener=replies({"message": {"content": content}})).call("p", "s") == {"x": 1}


def test_label_failures():
    none = lambda s: None
    with pytest.raises(BackendError, match="parse"):
        OllamaLabel(opener=replies(*[{"message": {"content": "garbage"}}] * 3), sleep=none).call("p", "s")
    with pytest.raises(BackendError, match="rate limit"):
        GatewayLabel(api_key="k", opener=replies(*[http(429)] * 8), sleep=none).call("p", "s")
    with pytest.raises(ValueError):
        GatewayLabel().check()


def test_request_retries():
    ok = lambda: replies(http(503), {"a": 1})
    assert json.loads(request("http://x", {"q": "1"}, backoff=0.0, opener=ok())) == {"a": 1}
    assert request("http://x", opener=replies(http(404))) is None
    assert request("http://x", backoff=0.0, opener=replies(*[http(500)] * 4)) is None


@pytest.fixture
def corpus(spark):
    rows = [(i, f"id{i}", f"10.1/{i}", t, None if i % 2 else "long abstract " + t, "en", 2000 + i) for i, t in enumerate(["sand grains on beaches", "granite weathering", "clay soils", "sand dunes"])]
    return spark.createDataFrame(rows, "ord long, id string, doi string, title string, abstract string, language string, year int")


def test_embed_diagnose_label(spark, corpus):
    anchors = spark.createDataFrame([(0, "sand grains. More"), (1, "granite weathering")], "anchor_idx int, text string")
    scored = pipelines.embed_and_score(corpus, anchors)
    top = {r["id"]: r["embed_top_anchor"] for r in scored.collect()}
    assert top["id1"] == 1 and top["id0"] == 0
    report = pipelines.diagnose(scored, anchors, 0.1)
    assert "| 0 | sand grains |" in report and "### [1] granite weathering" in report
    out = pipelines.label(scored, low=-1.0, pattern="sand").collect()
    assert {r["id"]: r["relevance_llm"] for r in out} == {"id0": "core", "id1": "off_topic", "id2": "off_topic", "id3": "core"}
    log = spark.createDataFrame([("id0", 1, "adjacent"), ("id0", 2, "off_topic")], "id string, chunk int, relevance_llm string")
    again = {r["id"]: r["relevance_llm"] for r in pipelines.label(scored, low=-1.0, log=log, pattern="sand").collect()}
    assert again["id0"] == "off_topic" and again["id3"] == "core"


def test_label_errors_become_rows(spark):
    df = spark.createDataFrame([("a", None, "down"), ("b", '{"relevance":"core"}', None)], "id string, reply string, error string")
    got = {r["id"]: (r["relevance_llm"], r["label_rationale"]) for r in labels.with_labels(df, "reply", "error").collect()}
    assert got == {"a": ("error", "down"), "b": ("core", "")}


def test_vectors(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [3.0, 4.0]), (2, None)], "ord int, embedding array<float>")
    anchors = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0])], "anchor_idx int, embedding array<float>")
    got = {r["ord"]: (r["embed_score"], r["embed_top_anchor"]) for r in vectors.score_anchors(df, anchors).collect()}
    assert got == {0: (0.0, 0), 1: (0.8, 1), 2: (None, -1)}
    with pytest.raises(Exception, match="has not 3 values"):
        vectors.checked(df, 3).select(F.sum(F.size("embedding"))).collect()


def test_quantiles_equal_those_of_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    rows = [(int(g), float(v)) for g, v in zip(rng.choice(3, 900, p=[0.8, 0.19, 0.01]), rng.choice([0.0, 0.25, 0.5, *rng.random(60)], 900), strict=True)]
    df = spark.createDataFrame([*rows, (1, None), (4, None), (None, 2.0)], "g int, v double")
    shares = {"low": 0.1, "mid": 0.5, "high": 0.9, "top": 1.0}
    got = {r["g"]: r for r in reports.quantiles(df, "v", shares, "g").collect()}
    assert set(got) == {g for g, _ in rows} | {None} and got[None]["mid"] == 2.0
    for g in {g for g, _ in rows}:
        own = [v for h, v in rows if h == g]
        assert (got[g]["n"], got[g]["min"], got[g]["max"]) == (len(own), min(own), max(own))
        assert [got[g][s] for s in shares] == pytest.approx(np.quantile(own, list(shares.values())).tolist())
    whole = reports.quantiles(df, "v", shares).collect()
    assert len(whole) == 1 and whole[0]["high"] == pytest.approx(np.quantile([*[v for _, v in rows], 2.0], 0.9))
    assert reports.score_stats(df.where("g = 4"), "v").first().asDict() == {"n": 0, "min": None, "median": None, "p75": None, "p90": None, "max": None, "n_p75": 0}


def test_reports_without_rows(spark):
    none = spark.createDataFrame([], "ord long, embed_score double, embed_top_anchor int")
    anchors = spark.createDataFrame([(0, "A"), (1, "B")], "anchor_idx int, text string")
    assert [r["n"] for r in reports.anchor_coverage(none, anchors).collect()] == [0, 0]
    assert "(none above the limit)" in reports.markdown_report(none, anchors)


def test_chase_and_caps(spark, corpus):
    works = corpus.withColumn("id", F.concat(F.lit("w"), "ord")).withColumn("doi", F.lit(None).cast("string")).withColumn("title", F.concat(F.lit("work "), "id"))
    works = works.withColumn("type", F.lit("article")).withColumn("authors", F.lit("")).withColumn("publication_year", F.col("year")).withColumn("cited_by_count", F.lit(1)).withColumn("open_access_url", F.lit("")).withColumn("source_database", F.lit("s"))
    core = corpus.withColumn("relevance_llm", F.when(F.col("ord") == 0, "core")).withColumn("embed_score", F.lit(0.5))
    edges = spark.createDataFrame([("w1", "id0", 1), ("w2", "id0", 2), ("w1", "id0", 3), ("id0", "w3", 4)], "src string, dst string, ord long")
    assert {r["id"] for r in pipelines.chase(core, works, edges, {}).collect()} == {"w1", "w2", "w3"}
    assert {r["id"] for r in citations.forward(edges, core.limit(1), cap=1).collect()} == {"w1"}


def test_backfill(spark, corpus):
    raw = spark.createDataFrame([("semantic_scholar", "q", json.dumps({"data": [{"paperId": "id1", "abstract": "from cache"}]}))], "source string, query string, payload_json string")
    table = spark.createDataFrame([("https://doi.org/10.1/3", "from lookup"), ("10.1/1", "late")], "doi string, text string")
    got = {r["id"]: r["abstract"] for r in pipelines.backfill(corpus, raw, [("s", table, 10)]).collect()}
    assert got["id1"] == "from cache" and got["id3"] == "from lookup" and got["id0"].startswith("long")
    capped = {r["id"]: r["abstract"] for r in pipelines.backfill(corpus, raw.limit(0), [("s", table, 1)]).collect()}
    assert capped["id1"] == "late" and capped["id3"] is None


def test_lookup_batches(spark):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(7)], "key string").coalesce(1)
    got = lookup_table(keys, "key", lambda ks: {k: str(len(ks)) for k in ks if k != "k3"}, batch=3).collect()
    assert len(got) == 6 and all(int(r["text"]) <= 3 for r in got)


def test_incremental_ingest(spark, corpus, tmp_path):
    src, out, seen = tmp_path / "in", str(tmp_path / "out"), []

    def compute(df):
        seen.append(df.count())
        return df.select("id", F.upper("title").alias("t"))

    for part in (corpus.where("ord < 2"), corpus):
        part.write.mode("append").parquet(str(src))
        stream = spark.readStream.schema(corpus.schema).parquet(str(src))
        incremental(stream, out, "id", compute, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == ["id0", "id1", "id2", "id3"]
    assert seen == [2, 2]


def test_abstract_lookups():
    from lexharbor.sources import lookup as L

    assert L.crossref_abstracts(["10.1/a", "10.1/b"], opener=replies({"message": {"abstract": "<p>x &amp; y</p>"}}, http(404))) == {"10.1/a": "x & y"}
    assert L.openalex_abstracts(["10.1/a"], opener=replies({"abstract_inverted_index": {"b": [1], "a": [0, 2]}})) == {"10.1/a": "a b a"}
    assert L.europepmc_abstracts(["10.1/a"], opener=replies({"resultList": {"result": [{}, {"abstractText": "t"}]}})) == {"10.1/a": "t"}
    assert L.semantic_scholar_abstracts(["10.1/a"], "k", opener=replies({"abstract": None})) == {}
    assert L.uid_payload(["WOS:1", "WOS:2"], "k", opener=replies({"Data": {}})) == '{"Data": {}}'


def test_words_that_cancel_out_have_a_vector():
    m = EMBED_BACKENDS["hashing"]().embed(["Is ernttier.", "is ernttier.", "Is", ""])
    assert abs((m[0] ** 2).sum() - 1) < 1e-5 and (m[0] == m[1]).all() and m[2].any() and not m[3].any()
