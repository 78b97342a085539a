"""Exact set-similarity joins by prefix filtering (rarest tokens first)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._storage import saved
from .graph import parts, spread_join


def jaccard(a: Column, b: Column) -> Column:
    """0 where either set is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(both.cast("double") / F.nullif(F.size(a) + F.size(b) - both, F.lit(0)), F.lit(0.0))


def _ranked(exploded: DataFrame, rarity: DataFrame) -> DataFrame:
    """``exploded`` with the ``df`` of its tokens: a token that most sets have is dealt over shares."""
    total = rarity.agg(F.sum("df")).first()[0] or 0
    return spread_join(exploded, rarity, "token", "df", "node", total)


def _prefixes(sets: DataFrame, rarity: DataFrame, threshold: float) -> DataFrame:
    """(node, bucket, n, token) for the tokens that a similar set must share at least one of."""
    exploded = sets.select("node", "bucket", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    ranked = _ranked(exploded, rarity).groupBy("node", "bucket", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("by_df"))
    length = (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int")
    return ranked.select("node", "bucket", "n", F.explode(F.slice("by_df", F.lit(1), length)).alias("x")).select("node", "bucket", "n", F.col("x.token").alias("token"))


def similar_pairs(left: DataFrame, right: DataFrame | None, threshold: float) -> DataFrame:
    """(a, b, similarity) with Jaccard >= threshold within a bucket.

    Inputs have node, bucket and tokens (distinct).  Without ``right`` it is a self join with a < b.
    Equi-joined on rare tokens, so neither side is ever compared with all of the other.
    """
    both = left if right is None else left.unionByName(right)
    rarity = saved(both.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df")), "rarity")
    a = _prefixes(left, rarity, threshold).select(F.col("node").alias("a"), "bucket", F.col("n").alias("n_a"), "token")
    b = (a.select(F.col("a").alias("b"), "bucket", F.col("n_a").alias("n_b"), "token")) if right is None else _prefixes(right, rarity, threshold).select(F.col("node").alias("b"), "bucket", F.col("n").alias("n_b"), "token")
    fits = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * threshold - 1e-9
    pairs = a.join(b, ["bucket", "token"]).where(fits)
    pairs = (pairs.where("a < b") if right is None else pairs).select("a", "b").distinct()
    other = left if right is None else right
    checked = pairs.join(left.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a").join(other.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b")
    return checked.withColumn("similarity", jaccard(F.col("ta"), F.col("tb"))).where(F.col("similarity") >= threshold).select("a", "b", "similarity")


def similarity_links(rows: DataFrame, threshold: float) -> DataFrame:
    """Rows (ord, bucket, sorted tokens) with class_id and n_links.

    Rows with equal sets are one class; only classes are joined, so a set that many rows share is
    never expanded into pairs of rows.
    """
    rows = saved(rows, "link-rows")
    classes = saved(rows.groupBy("bucket", "tokens").agg(F.min("ord").alias("node"), F.count(F.lit(1)).alias("n")), "link-classes")
    pairs = saved(similar_pairs(classes.select("node", "bucket", "tokens"), None, threshold).select("a", "b"), "link-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(classes.select(F.col("node").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("near")).withColumnRenamed("a", "node")
    counted = classes.join(near, "node", "left").withColumn("n_links", F.col("n") - 1 + F.coalesce("near", F.lit(0)))
    return rows.join(counted.withColumnRenamed("node", "class_id"), ["bucket", "tokens"])


#: Rounds before what is left is replayed, and edges of a connected part that one task replays.
ROUNDS, REPLAYED = 2, 200_000


def _replay(batches):
    """Edges (a, b, part), all those of a part in one partition, in the order of b: the nodes b that are caught."""
    caught: set[int] = set()
    for pdf in batches:
        out = []
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
            if a not in caught and b not in caught:  # a comes before b, so it is decided
                caught.add(b)
                out.append(b)
        yield pd.DataFrame({"b": out})


def _settled(edges: DataFrame, rounds: int | None = None) -> tuple[DataFrame | None, DataFrame]:
    """(caught nodes b, edges that are still open) after at most ``rounds`` rounds.

    Each round catches the neighbours of all nodes without an open earlier neighbour and closes their
    edges; a node that is never caught leads.
    """
    open_, caught, n = edges, None, 0
    while rounds is None or n < rounds:
        n += 1
        later = open_.select(F.col("b").alias("a")).distinct()
        fresh = open_.select("a").distinct().join(later, "a", "left_anti")
        now = saved(open_.join(fresh, "a", "left_semi").select("b").distinct(), "leader-caught")
        if now.isEmpty():
            break
        caught = now if caught is None else caught.unionByName(now)
        open_ = saved(open_.join(now, "b", "left_anti").join(now.withColumnRenamed("b", "a"), "a", "left_anti"), "leader-edges")
    return caught, open_


def _replayed(edges: DataFrame, limit: int) -> DataFrame:
    """The caught nodes b of ``edges``: parts of at most ``limit`` edges in one sorted pass of a task, others in rounds."""
    found, _ = parts(edges)
    # Every edge is found by its earlier end; a node with many is dealt over shares.
    degree = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    placed = saved(degree.join(found.withColumnRenamed("node", "a"), "a"), "leader-degrees")
    placed = saved(spread_join(edges, placed, "a", "n", "b", edges.count()).select("a", "b", "part"), "leader-parts")
    large = saved(placed.groupBy("part").count().where(F.col("count") > limit).select("part", F.lit(True).alias("large")), "leader-large")
    marked = placed.join(F.broadcast(large), "part", "left")  # fewer than one for each ``limit`` edges
    small = marked.where("large is null").select("a", "b", "part").repartition("part").sortWithinPartitions("b", "a")
    caught = saved(small.mapInPandas(_replay, "b long"), "leader-replayed")
    if not large.isEmpty():
        more, _ = _settled(saved(marked.where("large").select("a", "b"), "leader-rounds"))
        caught = caught.unionByName(more)
    return caught


def greedy_leaders(edges: DataFrame, rounds: int = ROUNDS, replayed: int = REPLAYED) -> DataFrame:
    """(node, leader) of the ordered greedy clustering over ``edges`` (a < b), for nodes with a leader.

    A node leads unless an earlier leader is its neighbour; it then joins the earliest such leader.
    Most edges are settled in a few rounds; what is open then hangs on long chains, whose connected parts
    are replayed in order, many of them in one sorted pass of a task.  A part of more than ``replayed`` edges
    is settled in further rounds.
    """
    edges = saved(edges.select("a", "b").distinct(), "leader-edges")
    caught, open_ = _settled(edges, rounds)
    if not open_.isEmpty():
        rest = _replayed(open_, replayed)
        caught = rest if caught is None else caught.unionByName(rest)
    if caught is None:
        return edges.select(F.col("b").alias("node"), F.col("a").alias("leader")).limit(0)
    led = edges.join(caught.withColumnRenamed("b", "a"), "a", "left_anti").join(caught, "b", "left_semi")
    return led.groupBy("b").agg(F.min("a").alias("leader")).select(F.col("b").alias("node"), "leader")
