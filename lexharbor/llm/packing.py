"""Sharding by best-fit-decreasing bin packing.

Indivisible groups (equal texts), largest first, each enter the open bin with the tightest
remaining capacity that still holds them; open bins sit in a balanced tree.  The packer works on
the histogram of group sizes: items of one size are interchangeable, so a run of them enters a bin
at once.  Distinct sizes d of a corpus of T bytes satisfy d(d+1)/2 <= T, which bounds what the
driver sees (14 million numbers at 100 TB if every size occurred; real texts have far fewer, as
their lengths gather below some megabytes); groups and rows never leave the executors.

Defined results: null text has no bytes and belongs to the group of empty texts; a group larger
than the fair share has a shard of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dense_index, settle, spread_join

#: Halvings of the search for the smallest capacity that needs no more than the given bins.
CAPACITY_STEPS = 18


class _Node:
    __slots__ = ("key", "left", "prio", "right")

    def __init__(self, key, prio):
        self.key, self.prio, self.left, self.right = key, prio, None, None


class FreeSpaceTree:
    """Balanced search tree (treap) of (remaining capacity, bin)."""

    def __init__(self):
        self.root, self.rng = None, random.Random(7)

    def _split(self, node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node.key < key:
            node.right, high = self._split(node.right, key)
            return node, high
        low, node.left = self._split(node.left, key)
        return low, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a.prio > b.prio:
            a.right = self._join(a.right, b)
            return a
        b.left = self._join(a, b.left)
        return b

    def add(self, key) -> None:
        low, high = self._split(self.root, key)
        self.root = self._join(self._join(low, _Node(key, self.rng.random())), high)

    def pop_tightest(self, size: int):
        """Remove and return the smallest key whose remaining capacity is at least ``size``."""
        node, best = self.root, None
        while node is not None:
            if node.key[0] >= size:
                best, node = node.key, node.left
            else:
                node = node.right
        if best is not None:
            low, high = self._split(self.root, best)
            _, high = self._split(high, (best[0], best[1] + 1))
            self.root = self._join(low, high)
        return best


def pack(sizes, counts, capacity: int, most_bins: int | None = None):
    """Best-fit-decreasing of a size histogram (sizes descending).

    Returns (segments, bins): segments (first item, bin) in item order, the items being sorted by
    size; None where more than ``most_bins`` bins would open.  A size above ``capacity`` is refused.
    """
    tree, segments, bins, item = FreeSpaceTree(), [], 0, 0
    for size, count in zip(sizes, counts, strict=True):
        size, count = int(size), int(count)
        if size > capacity:
            raise ValueError("a group is larger than the capacity")
        while count:
            free, at = tree.pop_tightest(size) or (None, None)
            if free is None:
                if most_bins is not None and bins >= most_bins:
                    return None, bins + 1
                free, at, bins = capacity, bins, bins + 1
            n = count if size == 0 else min(count, free // size)
            if not segments or segments[-1][1] != at:
                segments.append((item, at))
            item, count = item + n, count - n
            tree.add((free - n * size, at))
    return segments, bins


def plan_shards(sizes, counts, shards: int):
    """Segments for exactly ``shards`` bins of the smallest common capacity the search finds."""
    sizes, counts = [int(x) for x in sizes], [int(x) for x in counts]
    total, own, item = sum(s * c for s, c in zip(sizes, counts, strict=True)), [], 0
    # Groups above the fair share of what is left cannot be evened out: a bin for each.
    while sizes and shards - len(own) > 1 and sizes[0] > math.ceil(total / (shards - len(own))):
        own.append((item, len(own)))
        item, total, counts[0] = item + 1, total - sizes[0], counts[0] - 1
        if not counts[0]:
            sizes, counts = sizes[1:], counts[1:]
    bins = shards - len(own)
    least = max([math.ceil(total / bins), *sizes[:1]])
    low, high, best = 0.0, 1.0, None
    for _ in range(CAPACITY_STEPS):
        ratio = (low + high) / 2 if best is not None else high
        got, _ = pack(sizes, counts, int(least * (1 + ratio)), bins)
        if got is None:
            low, high = (ratio, high) if best is not None else (high, high * 2)
        else:
            best, high = got, ratio
    while best is None:
        high *= 2
        best, _ = pack(sizes, counts, int(least * (1 + high)), bins)
    return own + [(item + at, len(own) + b) for at, b in best]


def _placed(groups: DataFrame, segments) -> DataFrame:
    """Add the shard of each group's place ``idx`` in the order of decreasing size."""
    starts = np.array([s for s, _ in segments] or [0], dtype=np.int64)
    bins = np.array([b for _, b in segments] or [0], dtype=np.int32)
    held = groups.sparkSession.sparkContext.broadcast((starts, bins))

    def place(batches):
        starts, bins = held.value
        for pdf in batches:
            pdf["shard"] = bins[np.searchsorted(starts, pdf["idx"].to_numpy(), side="right") - 1]
            yield pdf[["grp", "g_bytes", "n", "shard"]]

    return groups.mapInPandas(place, "grp string, g_bytes long, n long, shard int")


def shard_groups(rows: DataFrame, plan) -> DataFrame:
    """Groups (grp, g_bytes, n, shard) of ``rows`` (grp, size); ``plan(sizes, counts)`` gives segments."""
    groups = rows.groupBy("grp").agg(F.sum("size").alias("g_bytes"), F.count(F.lit(1)).alias("n"))
    order = dense_index(groups, [F.col("g_bytes").desc(), F.col("grp")], "shard-groups")
    hist = order.groupBy("g_bytes").count().toPandas().sort_values("g_bytes", ascending=False)
    return settle(_placed(order, plan(hist["g_bytes"], hist["count"])), "shard-plan")


def fixed_capacity_shards(rows: DataFrame, capacity: int) -> DataFrame:
    """The general operator: as few shards of ``capacity`` as best-fit-decreasing finds."""
    return shard_groups(rows, lambda sizes, counts: pack(sizes, counts, capacity)[0])


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """(id, size, crc, shard, slot): near-equal shards of whole groups, slots gapless from 0."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(raw) + overhead).cast("long").alias("size"),
        F.crc32(raw).cast("long").alias("crc"),
        F.sha2(raw, 256).alias("grp"),
    )
    rows = settle(rows, "shard-rows")
    groups = shard_groups(rows, lambda sizes, counts: plan_shards(sizes, counts, shards))
    placed = spread_join(rows, groups.select("grp", "n", "shard"), "grp", "n", "id", rows.count())
    placed = dense_index(placed.drop("n"), ["shard", "grp", "id"], "shard-slots")
    first = placed.groupBy("shard").agg(F.min("idx").alias("first"))  # a row for each shard
    return placed.join(F.broadcast(first), "shard").select("id", "size", "crc", "shard", (F.col("idx") - F.col("first")).alias("slot"))
