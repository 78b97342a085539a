"""Near-duplicate detection with bottom-k sketches of one hash function.

Each text's set of word shingles is hashed once; its sketch holds the ``SKETCH`` smallest values.
Texts with the same set are one class, and only classes take part:

1. **Inverted lists of retained values.**  Two classes at the asked similarity share at least
   ``least_overlap`` retained values, so in any common order of values they share one of the first
   ``SKETCH - least_overlap + 1``.  The order is by the number of classes that retain a value, so lists
   are those of the rarest values: a passage that many texts share lines up only texts that hardly
   have anything else.  Lists with the same members are one list.
2. **Overlaps.**  Every class meets the hubs of its lists first.  What that links is one component;
   only lists with several components are then worked through: each member outside a list's largest
   component meets all others, so no pair of different components is left out and no pairs within a
   component are formed.
3. **Union-sketch estimation.**  A pair's similarity is estimated on the smallest values of the union.
4. **Exact Jaccard** on the full sets verifies what the estimate lets through.

Components are the connected components of the verified links.  A pair at the asked similarity of
0.8 is missed by list or estimate with probability below 1e-5 each (both are binomial tails, see
``least_overlap``); nothing is capped.  Sets are compared by 64-bit hashes of shingles, made of keyed
hashes of their words: two sets of a and b shingles share a value by accident with probability below
a * b / 2**61, whatever the words look like.

Defined results: null, empty and blank texts have no shingles and link with nothing; ties and
repeated rows are one class; rows that repeat an identifier with another text are judged by their own
text, and their components may share that identifier; a null identifier never becomes a class's
smallest unless all are null; very long texts are hashed whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SHARE_ROWS, discard, filter_bits, for_shares, joined_spread, settle, spread_join, tune, with_membership, with_shares
from .components import connected_components
from .shingles import shingle_sets

#: Retained values of a sketch, and standard errors that list and estimate allow for.
SKETCH, ERRORS = 64, 5.0
#: Members that each class of a list meets first.
HUBS = 4
#: Lists up to this length are paired by a join, longer ones in blocks of bounded size; the tests are the same.
JOINED_LIST = 64
BLOCK_CLASSES, BLOCK_SHINGLES = 2000, 1_000_000
_NONE = np.iinfo(np.int64).max


def sampled_overlap(percent: int) -> int:
    """Fewest shared values of two full sketches, but for a binomial tail of 1e-6."""
    p, tail, t = percent / 100, 0.0, 0
    while t < SKETCH:
        tail += math.comb(SKETCH, t) * p**t * (1 - p) ** (SKETCH - t)
        if tail > 1e-6:
            break
        t += 1
    return max(t, 1)


def least_overlap(n: Column, percent: int) -> Column:
    """Shared retained values that a class of ``n`` shingles has with every similar one.

    A sketch that holds the whole set misses none of the shared values but those that the other
    sketch had no room for; those are bounded by the sizes.
    """
    p = percent / 100
    whole = F.least(F.ceil(n * F.lit(percent) / 100), F.ceil(F.lit(SKETCH) - n * F.lit((1 - p) / p) - 1e-9))
    return F.greatest(F.when(n <= SKETCH, whole).otherwise(F.lit(sampled_overlap(percent))), F.lit(1)).cast("int")


def least_estimate(size, percent: int):
    """Least share of a union sketch of ``size`` values that counts as similar."""
    p = percent / 100
    return p - ERRORS * (p * (1 - p) / size) ** 0.5


def similar(inter, n_a, n_b, percent: int):
    return 100 * inter >= percent * (n_a + n_b - inter)


def sizes_fit(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def estimated(a: Column, b: Column, percent: int) -> Column:
    """Whether the union sketch of two sketches is similar enough."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    size = F.size(union)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    p = percent / 100
    return both / size >= F.lit(p) - F.lit(ERRORS) * F.sqrt(F.lit(p * (1 - p)) / size)


def union_estimates(sketch: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of ``sketch`` to each row of ``others`` (padded with _NONE), and its sample sizes."""
    both = np.sort(np.concatenate([np.broadcast_to(sketch, others.shape), others], axis=1), axis=1)
    again = np.zeros(both.shape, dtype=bool)
    again[:, 1:] = both[:, 1:] == both[:, :-1]
    place = np.cumsum(~again, axis=1)
    used = (both != _NONE) & (place <= SKETCH)
    size = (used & ~again).sum(axis=1)
    return (used & again).sum(axis=1) / np.maximum(size, 1), np.maximum(size, 1)


def _postings(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, bounds, members): members[bounds[i]:bounds[i + 1]] have values[i]."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(at, kind="stable")
    return values, np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(values)))]), owner[order]


def _overlaps(asked: np.ndarray, postings, members: int) -> np.ndarray:
    values, bounds, owner = postings
    at = np.searchsorted(values, asked)
    at = at[values[np.minimum(at, len(values) - 1)] == asked]
    lo, n = bounds[at], bounds[at + 1] - bounds[at]
    return np.bincount(owner[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())], minlength=members)


def block_links(asked: pd.DataFrame, members: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Verified links of ``asked`` to ``members`` (rep, label, values) that connect what all such links connect."""
    sets, own = [np.asarray(v) for v in members["values"]], members["rep"].to_numpy()
    size = np.array([len(s) for s in sets])
    sketches = np.full((len(sets), SKETCH), _NONE)
    for row, s in zip(sketches, sets, strict=True):
        row[: min(SKETCH, len(s))] = s[:SKETCH]
    retained, full = _postings([s[:SKETCH] for s in sets]), _postings(sets)
    label = members["label"].to_numpy().copy()
    asked_label, links = asked["label"].to_numpy().copy(), []
    for x, (rep, values) in enumerate(zip(asked["rep"].tolist(), asked["values"], strict=True)):
        values = np.asarray(values)
        fits = (100 * np.minimum(size, len(values)) >= percent * np.maximum(size, len(values))) & (label != asked_label[x])
        near = np.flatnonzero(fits)
        if len(near):
            near = near[_overlaps(values[:SKETCH], retained, len(sets))[near] > 0]
        if len(near):
            sketch = np.full(SKETCH, _NONE)
            sketch[: min(SKETCH, len(values))] = values[:SKETCH]
            guess, sample = union_estimates(sketch, sketches[near])
            near = near[guess >= least_estimate(sample, percent)]
        if len(near):
            near = near[similar(_overlaps(values, full, len(sets))[near], len(values), size[near], percent)]
        for m in near.tolist():
            if label[m] != asked_label[x]:
                links.append((rep, int(own[m])))
                old, new = label[m], asked_label[x]
                label[label == old], asked_label[asked_label == old] = new, new
    return links


def candidate_lists(classes: DataFrame, percent: int) -> DataFrame:
    """(value, l, l_n, rep, n): the lists of more than one class that similar classes are sure to share."""
    entries = classes.select("rep", "n", F.explode("sketch").alias("value"))
    counts = settle(entries.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "near-counts")
    total = classes.agg(F.sum(F.size("sketch"))).first()[0] or 0
    shared = with_membership(entries, "value", counts, "value", "maybe", filter_bits(counts.count())).where("maybe").drop("maybe")
    shared = spread_join(shared, counts, "value", "df", "rep", total)
    # Values that no other class retains stand first in the order, and are in no list.
    alone = F.least("n", F.lit(SKETCH)) - F.size("by_df")
    length = F.least("n", F.lit(SKETCH)) - least_overlap(F.col("n"), percent) + 1 - alone
    ranked = shared.groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("by_df"))  # at most SKETCH
    first = settle(ranked.where(length > 0).select("rep", "n", F.explode(F.slice("by_df", F.lit(1), length.cast("int"))).alias("x")).select("rep", "n", F.col("x.value").alias("value")), "near-first")
    lists = first.groupBy("value").agg(F.count(F.lit(1)).alias("l"), F.sum("n").alias("l_n"), F.sum(F.xxhash64("rep").cast("decimal(20,0)")).alias("who")).where("l > 1")
    lists = settle(lists.groupBy("l", "l_n", "who").agg(F.min("value").alias("value")).drop("who"), "near-lists")
    listed = with_membership(first, "value", lists, "value", "maybe", filter_bits(lists.count())).where("maybe").drop("maybe")
    listed = settle(spread_join(listed, lists, "value", "l", "rep", total), "near-listed")
    discard(counts, first)
    return listed


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component): component is the smallest linked identifier, null without shingles."""
    tune(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def digest(values: np.ndarray) -> str | None:
        return hashlib.blake2b(values.tobytes(), digest_size=16).hexdigest() if len(values) else None

    def sketch(batches):
        for pdf in batches:
            sets = list(shingle_sets(pdf["text"].tolist(), words))
            yield pd.DataFrame({"id": pdf["id"].astype("Int64"), "digest": [digest(s) for s in sets], "n": [len(s) for s in sets], "sketch": [s[:SKETCH] for s in sets]})

    rows = settle(texts.mapInPandas(sketch, "id long, digest string, n long, sketch array<long>"), "near-rows")
    named = rows.where("digest is not null and id is not null")
    classes = named.groupBy("digest").agg(F.min("id").alias("least"), F.min("n").alias("n"), F.count(F.lit(1)).alias("rows"), F.any_value("sketch").alias("sketch"))
    classes = settle(classes.withColumn("rep", F.monotonically_increasing_id()), "near-classes")  # written once, so a class keeps its number
    listed = candidate_lists(classes, percent)

    # Full sets of the classes in lists, once each.
    parts = settle(classes.select("rep", "digest", "least").join(listed.select("rep"), "rep", "left_semi"), "near-parts")

    def full(batches):
        for pdf in batches:
            sets = list(shingle_sets(pdf["text"].tolist(), words))
            yield pd.DataFrame({"digest": [digest(s) for s in sets], "least": pdf["id"], "sketch": [s[:SKETCH] for s in sets], "values": sets})

    chosen = with_membership(texts, "id", parts, "least", "maybe", filter_bits(parts.count())).where("maybe").select("id", "text")
    chosen = chosen.join(parts.select(F.col("least").alias("id")), "id", "left_semi").mapInPandas(full, "digest string, least long, sketch array<long>, values array<long>")
    sets = settle(chosen.join(parts, ["digest", "least"]).dropDuplicates(["rep"]).select("rep", "sketch", "values"), "near-sets")

    def verify(batches):
        for pdf in batches:
            inter = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(pdf["va"], pdf["vb"], strict=True)]
            n_a, n_b = (pdf[c].map(len).to_numpy() for c in ("va", "vb"))
            yield pdf.loc[similar(np.array(inter, dtype=np.int64), n_a, n_b, percent), ["a", "b"]]

    def verified(pairs: DataFrame, tag: str) -> DataFrame:
        """Pairs (a, b) that the union sketch lets through and full sets confirm."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").count().where(F.col("count") > SHARE_ROWS)
        hot = not ends.isEmpty()

        def side(rows: DataFrame, key: str, col: str) -> DataFrame:
            """A hub is in as many pairs as its list has members, so its set is sent to shares of them."""
            held = sets.select(F.col("rep").alias(key), F.col(col).alias(f"{col}_{key}"))
            return joined_spread(rows, held, key, F.struct("a", "b"), counted=rows.select("a", "b")) if hot else rows.join(held, key)

        step = (lambda df, name: settle(df, f"{tag}-{name}")) if hot else (lambda df, name: df)
        both = side(step(side(pairs, "a", "sketch"), "one"), "b", "sketch")
        likely = step(both.where(estimated(F.col("sketch_a"), F.col("sketch_b"), percent)).select("a", "b"), "likely")
        both = side(step(side(likely, "a", "values"), "two"), "b", "values").select("a", "b", F.col("values_a").alias("va"), F.col("values_b").alias("vb"))
        return settle(both.mapInPandas(verify, "a long, b long"), tag)

    # Each class meets the hubs of its lists.
    total = listed.count()
    lowest = [F.min(F.struct(F.xxhash64(F.lit(h), "rep").alias("h"), F.col("rep").alias("a"), F.col("n").alias("n_a"))) for h in range(HUBS)]
    hubs = listed.groupBy("value").agg(F.first("l").alias("l"), F.array_distinct(F.array(*lowest)).alias("hubs"))
    stars = spread_join(listed.select("value", "rep", "n"), hubs, "value", "l", "rep", total)
    stars = stars.select("rep", "n", F.explode("hubs").alias("hub")).select("rep", "n", "hub.a", "hub.n_a").where((F.col("rep") != F.col("a")) & sizes_fit("n", "n_a", percent))
    stars = settle(stars.select(F.least("rep", "a").alias("a"), F.greatest("rep", "a").alias("b")).distinct(), "near-stars")
    links = verified(stars, "near-star-links")

    # Lists that still have several components: all but the largest meet the whole list.
    labels = connected_components(links).select(F.col("node").alias("rep"), F.col("component").alias("label"))
    listed = settle(listed.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep")), "near-labelled")
    largest = listed.groupBy("value", "label").agg(F.count(F.lit(1)).alias("c"), F.first("l").alias("l")).groupBy("value").agg(F.max(F.struct("c", "label")).alias("top"), F.first("l").alias("l"))
    several = settle(largest.where("top.c < l").select("value", "l", F.col("top.label").alias("top")), "near-open")
    open_ = settle(spread_join(listed.drop("l"), several, "value", "l", "rep", total), "near-open-rows")

    short = open_.where(F.col("l") <= JOINED_LIST)
    a = short.where("label <> top").select("value", F.col("rep").alias("x"), F.col("n").alias("n_x"), F.col("label").alias("label_x"))
    pairs = a.join(short.select("value", "rep", "n", "label"), "value").where((F.col("label") != F.col("label_x")) & sizes_fit("n", "n_x", percent))
    pairs = settle(pairs.select(F.least("rep", "x").alias("a"), F.greatest("rep", "x").alias("b")).distinct().join(stars, ["a", "b"], "left_anti"), "near-pairs")
    links = links.unionByName(verified(pairs, "near-links"))

    long = open_.where(F.col("l") > JOINED_LIST)
    if not long.isEmpty():
        links = links.unionByName(settle(_long_list_links(long, sets, total, percent), "near-spans"))
    found = connected_components(links)
    # Components are named by the smallest identifier of their classes.
    linked = classes.select("digest", "rep", "rows", "least").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    linked = settle(linked.withColumn("group", F.coalesce("component", "rep")).select("digest", "rows", "least", "group", F.col("component").isNotNull().alias("linked")), "near-linked")
    smallest = linked.where("linked").groupBy("group").agg(F.min("least").alias("component"))
    placed = joined_spread(linked.where("linked").select("digest", "rows", "group"), smallest, "group", "digest").select("digest", "rows", "component")
    placed = settle(placed.unionByName(linked.where("not linked").select("digest", "rows", F.col("least").alias("component"))), "near-placed")
    discard(listed, open_, several, stars, parts, sets, classes)
    out = spread_join(rows.where("digest is not null").select("id", "digest", "n"), placed, "digest", "rows", "id", rows.count(), "left")
    out = out.select("id", F.col("n").alias("n_shingles"), "component")
    return out.unionByName(rows.where("digest is null").select("id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component")))


def _long_list_links(long: DataFrame, sets: DataFrame, total: int, percent: int) -> DataFrame:
    """Links between components of long lists.

    Members are cut by size class and into chunks; every member outside the largest component is sent
    to all chunks of its size class and the neighbouring ones, all members to one chunk each and to as
    many blocks of it as asked members need.
    """
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(percent / 100)) + 1e-9)
    long = long.withColumn("cls", size_class)
    asked = long.where("label <> top").withColumn("cls", F.explode(F.array(*[F.col("cls") + d for d in (-1, 0, 1)])))
    held = long.groupBy("value", "cls").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("m_n"))
    sent = asked.groupBy("value", "cls").agg(F.count(F.lit(1)).alias("s"), F.sum("n").alias("s_n"))
    chunks = lambda c, n: F.greatest(F.ceil(F.col(c) / BLOCK_CLASSES), F.ceil(F.col(n) / BLOCK_SHINGLES)).cast("long")
    plan = held.join(sent, ["value", "cls"]).select(F.xxhash64("value", "cls").alias("part"), "value", "cls", "m", "s", chunks("m", "m_n").alias("cm"), chunks("s", "s_n").alias("cs"))
    plan = settle(plan, "near-blocks")

    def dealt(rows: DataFrame, count: str, own: str, other: str, names: tuple[str, str], asked: bool) -> DataFrame:
        """Rows in their own chunk and in all blocks that the other side has with it."""
        keyed = rows.withColumn("part", F.xxhash64("value", "cls"))
        sizes = plan.select("part", F.col("value").alias("p_value"), F.col("cls").alias("p_cls"), F.col(count), F.col(own), F.col(other))
        got = with_shares(keyed, sizes, "part", count, "rep", total).join(for_shares(sizes, count, total), ["part", "_share"])
        got = got.where("value = p_value and cls = p_cls").withColumn(names[0], F.pmod(F.xxhash64("rep"), F.col(own)))
        got = got.withColumn(names[1], F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
        return got.select("value", "cls", "i", "j", "rep", "label", F.lit(asked).alias("asked"))

    blocks = dealt(long, "m", "cm", "cs", ("i", "j"), False).unionByName(dealt(asked, "s", "cs", "cm", ("j", "i"), True))
    blocks = blocks.join(sets.select("rep", "values"), "rep")

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        found = block_links(pdf[pdf["asked"]], pdf[~pdf["asked"]], percent) if pdf["asked"].any() and not pdf["asked"].all() else []
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return blocks.groupBy("value", "cls", "i", "j").applyInPandas(work, "a long, b long")
