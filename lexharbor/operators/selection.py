"""Exact order statistics of groups by counting, without sorting the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._storage import saved
from .graph import spread_join

#: Parts that a range is counted in, and values of a range that are put in order in one task.
PARTS, FEW = 1024, 4096


def _part(v: str, lo: str, hi: str):
    """0 for ``lo``, PARTS for ``hi``, between them by value; never falls where the value grows."""
    half = lambda c: F.col(c).cast("double") * 0.5  # noqa: E731  (a difference of halves does not overflow)
    share = F.nanvl(F.coalesce(F.try_divide(half(v) - half(lo), half(hi) - half(lo)), F.lit(0.5)), F.lit(0.5))
    inner = F.least(F.greatest(F.floor(share * (PARTS - 1)) + 1, F.lit(1)), F.lit(PARTS - 1))
    return F.when(F.col(v) <= F.col(lo), 0).when(F.col(v) >= F.col(hi), PARTS).otherwise(inner)


def select_places(values: DataFrame, places: DataFrame, few: int = FEW) -> DataFrame:
    """(g, place, v): the values at ``places`` (g, place from 0) of ``values`` (g, v, u) in ascending order.

    ``g`` is a struct, so that null is a group like any other; ``v`` is not null; NaN comes last; ``u`` deals
    rows of a hot group over tasks.  Counts of PARTS parts narrow the range around each place, and only
    rows in the ranges that are left are written again, until ranges hold ``few`` values or equal ones.
    Places outside a group have no row.
    """
    count = F.count(F.lit(1)).alias("n")
    ranges = values.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), count)
    wanted = places.groupBy("g").agg(F.collect_set("place").alias("places"))
    state = saved(ranges.join(wanted, "g").withColumn("before", F.lit(0).cast("long")), "select-ranges")
    rows = values.withColumn("before", F.lit(0).cast("long")).select(F.struct("g", "before").alias("key"), "v", "u")
    out, total = [], state.agg(F.sum("n")).first()[0] or 0
    while True:
        inside = state.select("g", "lo", "hi", "before", "n", F.explode("places").alias("place")).where("place >= before and place < before + n")
        out.append(inside.where("lo = hi").select("g", "place", F.col("lo").alias("v")))
        state = state.where("lo < hi").withColumn("key", F.struct("g", "before")).drop("g")
        most, left = state.agg(F.max("n"), F.sum("n")).first()
        if most is None or most <= few:
            break
        counted = spread_join(rows, state.select("key", "lo", "hi", "n"), "key", "n", "u", total).withColumn("part", _part("v", "lo", "hi"))
        counted = counted.groupBy("key", "part").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), count)
        upto = F.sum("n").over(Window.partitionBy("key").orderBy("part"))  # at most PARTS + 1 rows of a key
        counted = counted.join(state.select("key", "places"), "key").withColumn("before", F.col("key.before") + upto - F.col("n"))
        hit = F.filter("places", lambda p: (p >= F.col("before")) & (p < F.col("before") + F.col("n")))
        narrow = saved(counted.withColumn("places", hit).where("size(places) > 0").drop("part"), "select-ranges")
        ranges = narrow.where("lo < hi").groupBy("key").agg(F.collect_list(F.struct("lo", "hi", "before")).alias("ranges"))  # one for each place at most
        kept = spread_join(rows, ranges.join(state.select("key", "n"), "key"), "key", "n", "u", total)
        kept = kept.select("key", "v", "u", F.explode(F.filter("ranges", lambda r: (F.col("v") >= r["lo"]) & (F.col("v") <= r["hi"]))).alias("r"))
        rows = saved(kept.select(F.struct("key.g", "r.before").alias("key"), "v", "u"), "select-rows")
        state = narrow.select("key.g", "lo", "hi", "n", "before", "places")
        total = left
    if most is not None:
        open_ = rows.join(state.select("key", "places"), "key")
        open_ = open_.withColumn("place", F.col("key.before") + F.row_number().over(Window.partitionBy("key").orderBy("v")) - 1)  # at most ``few`` rows of a key
        out.append(open_.where(F.array_contains("places", F.col("place"))).select("key.g", "place", "v"))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found
