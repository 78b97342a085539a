import os

import pytest

from lexharbor.plans import queries as Q

from .oracle import assert_same, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_matches_oracle(spark, sf, con, name):
    assert_same(Q.QUERIES[name](spark, sf), con, Q.SQL[name])


def test_bibtex_keys_match_a_plain_loop(spark, sf):
    from pyspark.sql import functions as F

    from lexharbor.functions.bibtex import entry_key
    from lexharbor.plans.records import records

    r = records(spark, sf).withColumn("year", F.col("publication_year"))
    base = r.select("ord", entry_key(r["authors"], r["year"], r["publication_year"], r["title"]).alias("k")).orderBy("ord").collect()
    used, want = set(), {}
    for o, k in base:
        key, n = k, 0
        while key in used:
            key, n = k + chr(97 + n), n + 1
        used.add(key)
        want[o] = key
    assert {r[0]: r[1] for r in Q.bibtex_keys(spark, sf).collect()} == want


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert set(Q.QUERIES) == set(Q.SQL)
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_imports_without_a_session():
    """The driver may import the entry before it opens a session."""
    import subprocess
    import sys

    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), timeout=120)
    assert done.returncode == 0, done.stderr[-500:]
