import random

import pytest

from lexharbor.functions.text import STOPWORDS
from lexharbor.operators import filters, graph, simjoin
from lexharbor.operators.merge import compare_corpora, gap_fill_merge, title_matches
from lexharbor.operators.reports import check_source_coverage
from lexharbor.operators.resolve import cluster_leaders, resolve

LONG = "Grain size and shape of weathered granite saprolite from humid tropical catchments"
COLS = "ord long, doi string, title string, authors string, language string, source_database string"


def frame(spark, rows):
    cells = [(i, r.get("doi"), r.get("title"), r.get("authors"), r.get("language"), r.get("src", "a")) for i, r in enumerate(rows)]
    return spark.createDataFrame(cells, COLS)


@pytest.mark.parametrize(
    "rows, clusters, sources",
    [
        ([dict(doi="10.1/x", title="Foo", src="a"), dict(doi="10.1/x", title="Foo", src="b")], 1, {"a|b"}),
        ([dict(doi="https://doi.org/10.1/x", src="a"), dict(doi="10.1/X", src="b")], 1, {"a|b"}),
        ([dict(doi="10.1/pre", title=LONG, language="en", src="a"), dict(doi="10.2/jrn", title=LONG, language="en", src="b")], 1, {"a|b"}),
        ([dict(doi="10.1/v", title=LONG), dict(doi="10.1/v-v1", title=LONG)], 1, {"a"}),
        ([dict(doi=f"10.1/{i}", title="Introduction") for i in range(4)], 4, {"a"}),
        ([dict(doi="10.1/e", title=LONG, language="en"), dict(doi="10.1/s", title=LONG, language="es")], 2, {"a"}),
        ([dict(title=LONG, src="a"), dict(title=LONG, src="b")], 1, {"a|b"}),
        ([dict(doi="10.1/x", title=LONG, src="a"), dict(doi="10.1/x", title="Other", src="b"), dict(doi="10.9/z", title=LONG, src="c")], 1, {"a|b|c"}),
        ([], 0, set()),
    ],
)
def test_reference_cases(spark, rows, clusters, sources):
    out = resolve(frame(spark, rows)).collect()
    assert len(out) == clusters
    assert {r["source_databases"] for r in out} == sources


def test_resolving_twice_changes_nothing(spark):
    once = resolve(frame(spark, [dict(doi="10.1/x", src="a"), dict(doi="10.1/x", src="b")]))
    twice = resolve(once).collect()
    assert [r["source_databases"] for r in twice] == ["a|b"]


def test_corrupted_authors_are_repaired(spark):
    rows = [dict(doi="10.1/x", authors="; ".join(["N"] * 30)), dict(doi="10.1/x", authors="Doe, J")]
    assert resolve(frame(spark, rows)).first()["authors"] == "Doe, J"


def naive(rows, threshold=0.85, least=6):
    """The recurrence, row by row."""
    import re

    def tok(t):
        return {w for w in re.findall("[a-z0-9]+", (t or "").lower()) if w not in STOPWORDS and len(w) > 1}

    lead, first = [], {}
    for i, r in enumerate(rows):
        d = r.get("doi")
        if d and d in first:
            lead.append(lead[first[d]])
            continue
        t, pick = tok(r.get("title")), i
        for j in range(i):
            u = tok(rows[j].get("title"))
            same = (rows[j].get("language") or "").lower() == (r.get("language") or "").lower()
            if lead[j] == j and same and len(t) >= least and len(u) >= least and len(t & u) / len(t | u) >= threshold:
                pick = j
                break
        if d:
            first.setdefault(d, i)
        lead.append(pick)
    return lead


@pytest.mark.parametrize("seed", range(6))
def test_clusters_match_the_recurrence(spark, seed):
    rng = random.Random(seed)
    words = [f"word{i:02d}" for i in range(9)]
    rows = []
    for _ in range(60):
        title = " ".join(rng.sample(words, rng.choice([5, 7, 7, 8])))
        rows.append(dict(title=title, doi=rng.choice([None, None, f"10.1/{rng.randrange(30)}"]), language=rng.choice(["en", "en", "EN", None])))
    got = {r["ord"]: r["leader"] for r in cluster_leaders(frame(spark, rows)).collect()}
    assert [got[i] for i in range(len(rows))] == naive(rows)


def test_leader_clusters_are_not_transitive(spark):
    w = [f"token{i:02d}" for i in range(14)]
    a, b, c = w[:12], w[1:13], w[2:14]  # a~b and b~c at 11/13, a and c at 10/14
    rows = [dict(title=" ".join(x)) for x in (a, b, c)]
    got = {r["ord"]: r["leader"] for r in cluster_leaders(frame(spark, rows), threshold=0.8).collect()}
    assert got == {0: 0, 1: 0, 2: 2}


@pytest.mark.parametrize("before, after, bad", [(1.0, 0.0, True), (0.5, 0.19, True), (0.49, 0.0, False), (1.0, 0.2, False), (0.0, 0.0, False), (1.0, 1.0, False)])
def test_coverage_guard(spark, before, after, bad):
    make = lambda f: spark.createDataFrame([(i, "s" if i < f * 100 else "") for i in range(100)], "ord int, source_databases string")
    assert bool(check_source_coverage(make(before), make(after))) == bad


def test_gap_merge_keeps_sources(spark):
    from pyspark.sql import functions as F

    main, gap = frame(spark, [dict(doi="10.1/a", src="m")]), frame(spark, [dict(doi="10.1/a", src="g"), dict(doi="10.1/b", src="g")])
    out = gap_fill_merge(resolve(main), gap.withColumn("ord", F.col("ord") + 10)).collect()
    assert sorted(r["source_databases"] for r in out) == ["g", "g|m"]


@pytest.mark.parametrize("seed", range(3))
def test_title_matches_follow_the_greedy_order(spark, seed):
    import re

    rng = random.Random(seed)
    words = [f"word{i:02d}" for i in range(9)]
    make = lambda n: [dict(title=" ".join(rng.sample(words, rng.choice([6, 7, 8]))), doi=rng.choice([None, f"10.{rng.random()}"])) for _ in range(n)]
    left, right = make(25), make(25)
    tok = lambda r: set(re.findall("[a-z0-9]+", r["title"]))
    order = lambda rows: sorted(range(len(rows)), key=lambda i: (rows[i]["doi"] is None, i))
    taken, want = set(), set()
    for i in order(left):
        best, at = 0.0, None
        for j in order(right):
            s = len(tok(left[i]) & tok(right[j])) / len(tok(left[i]) | tok(right[j]))
            if j not in taken and s > best:
                best, at = s, j
        if best >= 0.85:
            taken.add(at)
            want.add((i, at))
    assert {(r["a"], r["b"]) for r in title_matches(frame(spark, left), frame(spark, right)).collect()} == want


def test_compare_corpora_statuses(spark):
    left = frame(spark, [dict(doi="10.1/a", title="x"), dict(title=LONG), dict(title="alone here")])
    right = frame(spark, [dict(doi="doi:10.1/A", title="y"), dict(doi="10.5/z", title=LONG)])
    got = {(r["side"], r["ord"]): r["status"] for r in compare_corpora(left, right).collect()}
    assert got == {("left", 0): "overlap_doi", ("left", 1): "overlap_title", ("left", 2): "only", ("right", 0): "overlap_doi", ("right", 1): "overlap_title"}


def test_equal_titles_match_in_order(spark):
    left, right = frame(spark, [dict(title=LONG)] * 40), frame(spark, [dict(title=LONG)] * 25)
    assert sorted((r["a"], r["b"]) for r in title_matches(left, right).collect()) == [(i, i) for i in range(25)]


# ------------------------------------------------------------------ parts and leaders
def plain_leaders(edges):
    near, leader = {}, {}
    for a, b in edges:
        near.setdefault(b, set()).add(a)
    for b in sorted(near):
        open_ = [a for a in near[b] if a not in leader]
        if open_:
            leader[b] = min(open_)
    return leader


def test_parts_of_a_long_chain_take_few_rounds(spark):
    edges = [(i, i + 1) for i in range(1000)] + [(5000, i) for i in range(2000, 2300)] + [(9, 9)]
    found, rounds = graph.parts(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["part"] for r in found.collect()} == {**{i: 0 for i in range(1001)}, **{i: 2000 for i in range(2000, 2300)}, 5000: 2000}
    assert rounds < 10


@pytest.mark.parametrize("rounds, replayed", [(0, 12), (1, 1 << 30), (0, 0)])
def test_leaders_of_parts_of_any_size(spark, monkeypatch, rounds, replayed):
    """All parts replayed, the large ones in rounds, all in rounds: one result."""
    monkeypatch.setattr(graph, "SHARE_ROWS", 4)
    rng = random.Random(11)
    edges = {tuple(sorted(rng.sample(range(120), 2))) for _ in range(90)} | {(200, 200 + i) for i in range(1, 30)} | {(300 + i, 301 + i) for i in range(15)}
    got = {r["node"]: r["leader"] for r in simjoin.greedy_leaders(spark.createDataFrame(sorted(edges) * 2, "a long, b long"), rounds, replayed).collect()}
    assert got == plain_leaders(edges)
    assert simjoin.greedy_leaders(spark.createDataFrame([], "a long, b long"), rounds, replayed).collect() == []


def test_a_chain_of_a_thousand_is_replayed(spark):
    edges = [(i, i + 1) for i in range(1000)]
    got = {r["node"]: r["leader"] for r in simjoin.greedy_leaders(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == plain_leaders(edges) == {i: i - 1 for i in range(1, 1001, 2)}


def test_words_of_most_titles_are_spread(spark, monkeypatch):
    monkeypatch.setattr(graph, "SHARE_ROWS", 4)
    rng = random.Random(6)
    rows = [dict(title="common shared usual " + " ".join(rng.sample([f"word{i:02d}" for i in range(9)], 5))) for _ in range(60)]
    got = {r["ord"]: r["leader"] for r in cluster_leaders(frame(spark, rows)).collect()}
    assert [got[i] for i in range(60)] == naive(rows)


def test_spread_join_is_a_join(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(graph, "SHARE_ROWS", 4)
    rows = spark.range(0, 300).select(F.when(F.col("id") < 100, 7).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("r"))
    sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.col("k") * 10)
    assert sorted((r["k"], r["r"], r["v"]) for r in graph.spread_join(rows, sizes, "k", "n", "r", 300).collect()) == sorted((r["k"], r["r"], r["k"] * 10) for r in rows.collect())


def test_rows_without_keys_are_kept(spark):
    rows = [(1, "a", "10.1/x"), (2, None, None), (3, "c", ""), (4, "d", "10.1/Y"), (5, None, "10.1/z")]
    df = spark.createDataFrame(rows, "ord long, id string, doi string")
    listed = spark.createDataFrame([("10.1/X ",), ("",), (None,)], "doi string")
    assert [r["ord"] for r in filters.exclude_dois(df, listed).orderBy("ord").collect()] == [2, 3, 4, 5]
    old = spark.createDataFrame([("c", "10.1/y"), (None, None)], "id string, doi string")
    assert [r["ord"] for r in filters.not_present(df, old).orderBy("ord").collect()] == [1, 2, 5]


def replayed_matches(pairs, left, right):
    """Plain loop: left rows in order take the best free right row."""
    near, taken, out = {}, set(), set()
    for a, b, s in pairs:
        near.setdefault(a, {})[b] = s
    for c, late, o in sorted(left, key=lambda r: (r[1], r[2])):
        free = [(-near[c][d], late_r, p) for d, late_r, p in right if d in near.get(c, {}) and p not in taken]
        if free:
            taken.add(min(free)[2])
            out.add((o, min(free)[2]))
    return out


@pytest.mark.parametrize("seed,rounds,replayed", [(0, 2, 100_000), (1, 1, 5), (2, 1, 0), (3, 50, 100_000), (4, 1, 0), (5, 2, 20)])
def test_greedy_matches_equal_the_replay(spark, seed, rounds, replayed):
    """Few similarities, so many ties; classes of one to thirty rows, interleaved in order."""
    from lexharbor.operators.matching import greedy_matches

    rng = random.Random(seed)
    nodes = 8 if seed % 2 else 14
    pairs = [(a, b, rng.choice([0.85, 0.9, 1.0])) for a in range(nodes) for b in range(nodes) if rng.random() < 0.25]
    make = lambda: [(rng.choice([*range(nodes), 0]), rng.random() < 0.5, o) for o in rng.sample(range(1000), 60)]
    left, right = make(), make()
    frames = [spark.createDataFrame(rows, "c long, late boolean, o long") for rows in (left, right)]
    got = greedy_matches(spark.createDataFrame(pairs, "a long, b long, s double"), *frames, rounds, replayed).collect()
    assert len(got) == len({r["a"] for r in got}) == len({r["b"] for r in got})
    assert {(r["a"], r["b"]) for r in got} == replayed_matches(pairs, left, right)


def test_a_large_class_is_matched_by_places(spark):
    """100,000 alike rows on each side, in one part: settled in a round, no task replays them."""
    from pyspark.sql import functions as F

    from lexharbor.operators import matching

    rows = spark.range(100_000).select(F.lit(7).cast("long").alias("c"), F.lit(False).alias("late"), F.col("id").alias("o"))
    pairs = spark.createDataFrame([(7, 7, 1.0)], "a long, b long, s double")
    got = matching.greedy_matches(pairs, rows, rows.where("o % 2 = 0"), replayed=0)
    assert got.agg(F.count(F.lit(1)), F.count_if(F.col("b") == 2 * F.col("a")), F.max("a")).first() == (50_000, 50_000, 49_999)


def test_no_pairs_match_nothing(spark):
    from lexharbor.operators.matching import greedy_matches

    rows = spark.createDataFrame([(1, False, 1)], "c long, late boolean, o long")
    assert greedy_matches(spark.createDataFrame([], "a long, b long, s double"), rows, rows).collect() == []
