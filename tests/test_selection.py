"""Order statistics by counting against numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexharbor.operators.reports import quantiles
from lexharbor.operators.selection import select_places


def places_of(spark, values, few):
    """All places of all groups, or every seventh."""
    rows = spark.createDataFrame(values, "k string, v double").select(F.struct(F.col("k").alias("g")).alias("g"), "v", F.rand(1).alias("u"))
    sizes = {}
    for k, _ in values:
        sizes[k] = sizes.get(k, 0) + 1
    asked = [(k, p) for k, n in sizes.items() for p in sorted({0, n - 1, n // 2, n // 3, n // 10})]
    wanted = spark.createDataFrame(asked, "k string, place long").select(F.struct(F.col("k").alias("g")).alias("g"), "place")
    got = {(r["g"]["g"], r["place"]): r["v"] for r in select_places(rows, wanted, few).collect()}
    want = {}
    for k, p in asked:
        want[k, p] = sorted((v for g, v in values if g == k), key=lambda v: (math.isnan(v), v))[p]
    return got, want


@pytest.mark.parametrize("few", [1, 50])
def test_places_of_odd_values(spark, few):
    rng = random.Random(few)
    values = [("a", rng.gauss(0, 1)) for _ in range(400)] + [("a", 0.25)] * 300
    values += [(None, math.exp(rng.uniform(-300, 300))) for _ in range(200)] + [(None, v) for v in (math.inf, -math.inf, -math.inf)]
    values += [("ends", v) for v in (-1.7e308, 1.7e308, 5e-324, 0.0, 1e-323)] + [("same", 3.0)] * 60 + [("one", -1.0)]
    got, want = places_of(spark, values, few)
    assert got == want


def test_nan_comes_last(spark):
    values = [("a", v) for v in (math.nan, 1.0, 2.0, math.nan, 3.0, math.inf)]
    got, want = places_of(spark, values, 1)
    assert {k: str(v) for k, v in got.items()} == {k: str(v) for k, v in want.items()}


def test_quantiles_equal_numpy(spark, monkeypatch):
    from lexharbor.operators import selection

    monkeypatch.setattr(selection.select_places, "__defaults__", (16,))
    rng = np.random.default_rng(3)
    data = [(g, float(v)) for g, n in ((1, 5000), (2, 37), (None, 900)) for v in rng.normal(size=n).round(3)] + [(3, None)]
    df = spark.createDataFrame(data, "g int, x double")
    got = {r["g"]: r for r in quantiles(df, "x", {"p10": 0.1, "p50": 0.5, "p99": 0.99}, "g").collect()}
    assert set(got) == {1, 2, None}
    for g, r in got.items():
        v = [x for k, x in data if k == g]
        assert (r["n"], r["min"], r["max"]) == (len(v), min(v), max(v))
        assert [r["p10"], r["p50"], r["p99"]] == pytest.approx(np.quantile(v, [0.1, 0.5, 0.99]).tolist(), abs=1e-12)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "g int, x double")
    assert quantiles(df, "x", {"p": 0.5}, "g").collect() == [] == quantiles(df, "x", {"p": 0.5}).collect()


def test_the_plan_does_not_sort_the_values(spark):
    df = spark.range(50_000).select(F.lit(1).alias("g"), F.rand(2).alias("x"))
    plan = quantiles(df, "x", {"p": 0.5}, "g")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan and "Sort [" not in plan
