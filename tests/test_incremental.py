"""New rows against a kept index: the result of resolving all rows together."""

import random

import pytest
from pyspark.sql import functions as F

from lexharbor.operators.incremental import ResolutionIndex, resolve_in_batches, split_by
from lexharbor.operators.resolve import cluster_leaders, resolve

from .test_resolve import LONG, frame


def some_rows(seed, n):
    rng = random.Random(seed)
    words = [f"word{i:02d}" for i in range(9)] + [f"only{seed}{i}" for i in range(2)]
    return [
        dict(
            title=" ".join(rng.sample(words, rng.choice([5, 7, 8, 9]))), doi=rng.choice([None, None, f"10.1/{rng.randrange(40)}"]), language=rng.choice(["en", "en", "EN", None]),
            src=rng.choice("abc"), authors=rng.choice([None, "Doe, J", "; ".join(["N"] * 30)]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1])
def test_batches_give_what_one_resolution_gives(spark, tmp_path, seed):
    rows = some_rows(seed, 50) + some_rows(seed + 10, 30) + some_rows(seed + 20, 20)
    df = frame(spark, rows).withColumn("extra", F.concat(F.lit("x"), "ord"))
    cuts = [df.where("ord < 50"), df.where("ord >= 50 and ord < 80"), df.where("ord >= 80")]
    got = {r["ord"]: r for r in resolve_in_batches(cuts, (tmp_path / "index").as_uri()).collect()}
    want = {r["ord"]: r for r in resolve(df).collect()}
    assert set(got) == set(want)
    for o, r in want.items():
        assert (got[o]["source_databases"], got[o]["authors"], got[o]["extra"], got[o]["title"]) == (r["source_databases"], r["authors"], r["extra"], r["title"])


def test_leaders_join_batch_after_batch(spark, tmp_path):
    rows = some_rows(5, 40) + some_rows(6, 40)
    df = frame(spark, rows)
    index = ResolutionIndex(spark, (tmp_path / "i").as_uri())
    led = {r["ord"]: r["leader"] for r in index.build(df.where("ord < 40")).collect()}
    for again in range(2):  # a batch that runs again overwrites its own part
        got = {r["ord"]: r["leader"] for r in index.probe(df.where("ord >= 40"), 1).collect()}
        assert {**led, **got} == {r["ord"]: r["leader"] for r in cluster_leaders(df).collect()}
    assert index.probe(df.limit(0), 2).collect() == []
    with pytest.raises(ValueError, match="does not come after"):
        index.probe(df.where("ord between 30 and 50"), 2)
    with pytest.raises(ValueError, match="no index"):
        ResolutionIndex(spark, (tmp_path / "none").as_uri()).probe(df, 1)


def test_chains_are_not_closed_over_the_index(spark, tmp_path):
    w = [f"token{i:02d}" for i in range(14)]
    rows = [dict(title=" ".join(x)) for x in (w[:12], w[1:13], w[2:14])] + [dict(), dict(doi="10.1/q", title=LONG), dict(doi="10.1/q")]
    index = ResolutionIndex(spark, (tmp_path / "i").as_uri(), threshold=0.8)
    df = frame(spark, rows)
    index.build(df.where("ord < 1"))
    got = {r["ord"]: r["leader"] for r in index.probe(df.where("ord >= 1"), 1).collect()}
    assert got == {1: 0, 2: 2, 3: 3, 4: 4, 5: 4}


def test_an_empty_index_takes_rows(spark, tmp_path):
    df = frame(spark, some_rows(8, 30))
    out = resolve_in_batches([df.limit(0), df], (tmp_path / "i").as_uri())
    assert {(r["ord"], r["source_databases"]) for r in out.collect()} == {(r["ord"], r["source_databases"]) for r in resolve(df).collect()}


def test_only_rows_that_may_match_are_moved(spark):
    table = spark.range(0, 5000).select(F.col("id"), F.when(F.col("id") % 10 > 0, F.concat(F.lit("k"), "id")).alias("k"), F.lit("mine").alias("_page"))
    keys = spark.range(0, 5000, 100).select(F.concat(F.lit("k"), F.col("id") + 1).alias("x"))
    hit, rest = split_by(table, F.col("k"), keys, "x")
    assert hit.columns == table.columns == rest.columns
    found = {r["id"] for r in hit.collect()}
    assert {i + 1 for i in range(0, 5000, 100)} <= found and len(found) < 60 and hit.count() + rest.count() == 5000
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
