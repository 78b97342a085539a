"""Greedy one-to-one matching of two tables, by pairs of classes of alike rows.

Left rows act in order; each takes the most similar right row that is still free, of equally similar ones
the first.  All left rows of a class have the same candidates, and all right rows of a class are equally
similar to a left row, so the rows of a class that are taken are always its first ones.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._storage import saved
from .graph import parts, spread_join
from .ranking import global_rank

#: Rounds before what is left is replayed, and rows and pairs of a connected part that one task replays.
ROUNDS, REPLAYED = 2, 100_000


def _replay(pdf: pd.DataFrame) -> pd.DataFrame:
    """Left rows in order take the best right row still free, the first on ties.

    ``kind`` 0: classes a and b with their similarity; 1 and 2: rows ``o`` of a left and a right class,
    late ones after all others.  Rows of one right class are alike, so its first free row is all that
    has to be looked at.
    """
    near: dict[int, list] = {}
    for a, b, s in pdf.loc[pdf["kind"] == 0, ["a", "b", "s"]].itertuples(index=False):
        near.setdefault(int(a), []).append((-s, int(b)))
    rows: dict[int, list] = {1: [], 2: []}
    for kind, c, late, o in pdf.loc[pdf["kind"] > 0, ["kind", "c", "late", "o"]].itertuples(index=False):
        rows[kind].append((bool(late), int(o), int(c)))
    free: dict[int, list] = {}
    for late, o, c in sorted(rows[2], reverse=True):
        free.setdefault(c, []).append((late, o))
    out = []
    for _, o, c in sorted(rows[1]):
        best = min(((s, free[b][-1], b) for s, b in near.get(c, ()) if free.get(b)), default=None)
        if best:
            out.append((o, free[best[2]].pop()[1]))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _placed(rows: DataFrame, tag: str) -> DataFrame:
    """(c, k, o, i): ``rows`` (c, late, o) with their order ``k`` and place ``i`` over all classes.

    Places of one class are consecutive; only differences within a class are used.
    """
    ordered = rows.select("c", F.struct("late", "o").alias("k"), "o")
    return saved(global_rank(ordered, ["c", "k"], "i"), tag)


def _heads(rows: DataFrame, node: str) -> DataFrame:
    """(node, k, i, n): first remaining row and number of remaining rows of each class."""
    heads = rows.groupBy("c").agg(F.min("k").alias("k"), F.min("i").alias("i"), F.count(F.lit(1)).alias("n"))
    return heads.select(F.col("c").alias(node), F.col("k").alias(f"k_{node}"), F.col("i").alias(f"i_{node}"), F.col("n").alias(f"n_{node}"))


def _without(rows: DataFrame, taken: DataFrame, col: str, tag: str) -> DataFrame:
    return saved(rows.join(taken.select(F.col(col).alias("o")), "o", "left_anti"), tag)


def _round(pairs: DataFrame, left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(live pairs, final matches (a, b) of rows) of what remains.

    Every class of left rows asks the class that holds its best free row.  Rows that ask a class take its
    rows in order, as far as no earlier row of a class that now asks elsewhere could come to it, and
    no equally similar class has an earlier row.  The first of all rows is always served.
    """
    heads = saved(_heads(left, "a"), "match-left"), saved(_heads(right, "b"), "match-right")
    live = saved(pairs.select("a", "b", "s").join(heads[0], "a").join(heads[1], "b"), "match-pairs")
    best = Window.partitionBy("a").orderBy(F.col("s").desc(), "k_b", "b")
    two = live.withColumn("_r", F.row_number().over(best)).where("_r <= 2").groupBy("a").agg(
        *[F.min_by(c, "_r").alias(c) for c in ("b", "i_b", "i_a", "n_a")], F.max("s").alias("_s"), F.max(F.when(F.col("_r") == 2, F.struct("s", "k_b"))).alias("_next")
    )
    # A class may give its rows before those of an equally similar one only.
    asked = saved(two.select("a", "b", "i_a", "i_b", "n_a", F.when(F.col("_next.s") == F.col("_s"), F.col("_next.k_b")).alias("before")), "match-asked")
    elsewhere = live.join(asked.select("a", F.col("b").alias("_b")), "a").where("b <> _b").groupBy("b").agg(F.min("k_a").alias("until"))
    suitors = asked.groupBy("b").agg(F.count(F.lit(1)).alias("suitors"))
    asked = saved(asked.join(suitors, "b").join(elsewhere, "b", "left").withColumnRenamed("a", "c"), "match-asked")
    asking = spread_join(left, asked, "c", "n_a", "o", left.count()).where("until is null or k < until")
    asking = asking.select("b", "c", "k", "o", "suitors", "before", "i_b", (F.col("i") - F.col("i_a")).alias("j"))
    alone, shared = asking.where("suitors = 1").drop("suitors"), saved(asking.where("suitors > 1").drop("suitors", "j"), "match-shared")
    if not shared.isEmpty():  # one queue of all classes that ask
        queue = saved(global_rank(shared, ["b", "k"], "_q"), "match-queue")
        firsts = queue.groupBy("b").agg(F.min("_q").alias("_first"), F.count(F.lit(1)).alias("_n"))
        queue = spread_join(queue, firsts, "b", "_n", "o", queue.count())
        alone = alone.unionByName(queue.withColumn("j", F.col("_q") - F.col("_first")).drop("_q", "_first", "_n"))
    given = right.select(F.col("c").alias("b"), F.col("i").alias("_i"), F.col("k").alias("_k"), F.col("o").alias("_o"))
    met = alone.withColumn("_i", F.col("i_b") + F.col("j")).join(given, ["b", "_i"])
    met = saved(met.select("b", "j", F.col("o").alias("_a"), "_o", (F.col("before").isNotNull() & (F.col("_k") > F.col("before"))).alias("_stop")), "match-met")
    stops = met.where("_stop").groupBy("b").agg(F.min("j").alias("_end"))
    final = met.join(stops, "b", "left").where("_end is null or j < _end").select(F.col("_a").alias("a"), F.col("_o").alias("b"))
    return live.select("a", "b", "s"), saved(final, "match-final")


def _rounds(pairs: DataFrame, left: DataFrame, right: DataFrame, rounds: int | None) -> tuple[DataFrame | None, DataFrame, DataFrame, DataFrame]:
    """(matches, pairs, left rows, right rows that remain) after at most ``rounds`` rounds."""
    out, n = None, 0
    while rounds is None or n < rounds:
        n += 1
        pairs, final = _round(pairs, left, right)
        if final.isEmpty():
            return out, pairs, left, right
        out = final if out is None else out.unionByName(final)
        left, right = _without(left, final, "a", "match-left"), _without(right, final, "b", "match-right")
    return out, pairs, left, right


def greedy_matches(pairs: DataFrame, left: DataFrame, right: DataFrame, rounds: int = ROUNDS, replayed: int = REPLAYED) -> DataFrame:
    """(a, b): rows of ``left`` and ``right`` (c, late, o) matched over classes ``pairs`` (a, b, s).

    ``o`` is unique in its table; rows that are ``late`` come after all others.  Whatever is settled
    by queues of classes is settled in rounds, a class of any size in one.  Connected parts of what is then
    open are replayed in order, those of more than ``replayed`` rows and pairs in further rounds.
    """
    some = lambda df, col: df.join(pairs.select(F.col(col).alias("c")).distinct(), "c", "left_semi")
    left, right = _placed(some(left, "a"), "match-left"), _placed(some(right, "b"), "match-right")
    out, pairs, left, right = _rounds(pairs, left, right, rounds)
    if out is None:
        return left.select(F.col("o").alias("a"), F.col("o").alias("b")).limit(0)
    pairs = saved(pairs.join(left.select(F.col("c").alias("a")).distinct(), "a", "left_semi").join(right.select(F.col("c").alias("b")).distinct(), "b", "left_semi"), "match-open")
    if pairs.isEmpty():
        return out
    # Left classes get even numbers in the graph, right ones odd numbers.
    found, _ = parts(pairs.select((F.col("a") * 2).alias("a"), (F.col("b") * 2 + 1).alias("b")), "match-parts")
    found = saved(found, "match-parts")
    place = lambda side: found.where(F.pmod("node", F.lit(2)) == side).select(F.shiftright("node", 1).alias("c"), "part")
    unused = F.lit(-1).cast("long")  # not null: pandas would read the column as floats
    edges = pairs.withColumnRenamed("a", "c").join(place(0), "c").select(
        "part", F.lit(0).alias("kind"), F.col("c").alias("a"), "b", "s", unused.alias("c"), F.lit(False).alias("late"), unused.alias("o")
    )
    for kind, rows in ((1, left), (2, right)):
        sizes = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n")).join(place(kind - 1), "c")
        member = spread_join(rows, sizes, "c", "n", "o", rows.count())
        edges = edges.unionByName(member.select("part", F.lit(kind).alias("kind"), unused.alias("a"), unused.alias("b"), F.lit(0.0).alias("s"), "c", "k.late", "o"))
    edges = saved(edges, "match-rest")
    large = saved(edges.groupBy("part").count().where(F.col("count") > replayed).select("part", F.lit(True).alias("large")), "match-large")
    marked = edges.join(F.broadcast(large), "part", "left")  # fewer than one for each ``replayed`` rows
    small = marked.where("large is null").drop("large").groupBy("part").applyInPandas(_replay, "a long, b long")
    out = out.unionByName(saved(small, "match-replayed"))
    if not large.isEmpty():
        rest = saved(marked.where("large"), "match-rounds")
        kept = lambda rows, kind: rows.join(rest.where(F.col("kind") == kind).select("o"), "o", "left_semi")
        more, *_ = _rounds(rest.where("kind = 0").select("a", "b", "s"), kept(left, 1), kept(right, 2), None)
        out = out if more is None else out.unionByName(more)
    return out
