"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact token length within their source.  A source's target gives whole
passes over it and a remaining budget; lengths share all but the last of it in proportion, longest
first, with the error carried on, and bounded-knapsack dynamic programming over the counts that are
left spends what then remains (about two longest documents), to the nearest sum there is.  Of each length the documents with the
smallest seeded hashes are taken, so reruns agree.

Defined results: a null source is a source of its own, last; null or blank text has size 0 and is
taken as 0 words; a source without words has target 0; rows that repeat an identifier, or have none,
are drawn one by one; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, dense_index, settle

#: Weights in the order of the sources, repeating.
WEIGHTS = (3, 1, 2)


def reshared_targets(sizes: list[int], weights: list[float], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Share ``share`` of all sizes by weight; none above ``most`` times its size, the excess reshared."""
    budget, out, open_ = share * sum(sizes), [0.0] * len(sizes), list(range(len(sizes)))
    while open_:
        each = budget / sum(weights[i] for i in open_)
        over = [i for i in open_ if each * weights[i] > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = each * weights[i]
            break
        for i in over:
            out[i] = most * sizes[i]
            budget -= out[i]
        open_ = [i for i in open_ if i not in set(over)]
    return out


def subset_sum(lengths: list[int], counts: list[int], budget: int, over: int = 0) -> dict[int, int]:
    """Bounded knapsack: counts by length whose sum is nearest to ``budget``, at most ``over`` above it."""
    mask, reach, steps = (1 << (budget + over + 1)) - 1, 1, []
    for length, count in zip(lengths, counts, strict=True):
        if length <= 0 or length > budget + over:
            continue
        count, part = min(count, (budget + over) // length), 1
        while count and not reach >> budget & 1:
            k = min(part, count)
            steps.append((reach, length, k))
            reach |= (reach << (length * k)) & mask
            count, part = count - k, part * 2
    below = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reach >> budget
    above = budget + (above & -above).bit_length() - 1 if above else None
    left, used = above if above is not None and above - budget < budget - below else below, {}
    for before, length, k in reversed(steps):
        if not before >> left & 1:
            used[length] = used.get(length, 0) + k
            left -= length * k
    return used


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length (descending) to take so that the sum is nearest to ``budget``.

    Lengths share the budget less two longest documents in proportion; the knapsack spends the rest.
    """
    total = int((lengths * counts).sum())
    taken, owed = np.zeros(len(lengths), dtype=np.int64), 0
    if not total or budget <= 0:
        return taken
    longest = int(lengths[0])
    shared = max(0, budget - 2 * longest)
    # Exact integers: what is owed is shared * words so far / total, less what was taken.
    for i, (length, count) in enumerate(zip(lengths.tolist(), counts.tolist(), strict=True)):
        owed += shared * length * count
        if length:
            taken[i] = min(count, owed // (length * total))
            owed -= int(taken[i]) * length * total
    rest = budget - int((lengths * taken).sum())
    extra = subset_sum(lengths.tolist(), (counts - taken).tolist(), rest, longest)
    return taken + np.array([extra.get(x, 0) for x in lengths.tolist()], dtype=np.int64)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, keep: bool = False) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) for every document; with ``keep`` also its row as ``doc``."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.col(source_col).isNull().alias("no_source"),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(text_col)).alias("text_hash"),  # tells rows with one identifier, or none, apart
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if keep else []),
    ).withColumn("draw", F.xxhash64(F.lit(seed), F.coalesce("id", "text_hash")))
    rows = dense_index(rows, ["no_source", "source", "size", "draw", "id", "text_hash"], "mix-rows")
    # One row for each source and length; its documents are neighbours in the index.
    hist = settle(rows.groupBy("no_source", "source", "size").agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("first")), "mix-hist")
    totals = hist.groupBy("no_source", "source").agg(F.sum(F.col("size") * F.col("n")).alias("words")).collect()
    totals = sorted(totals, key=lambda r: (r["no_source"], (r["source"] or "").encode()))
    sizes = [int(r["words"]) for r in totals]
    targets = reshared_targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))])
    aims = {r["source"]: (n, t) for r, n, t in zip(totals, sizes, targets, strict=True)}

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        source = pdf["source"].iloc[0]
        words, target = aims[source if isinstance(source, str) else None]
        pdf = pdf.sort_values("size", ascending=False)
        passes = int(target // words) if words else 0
        budget = round(target - passes * words)
        pdf["extra"] = fit_budget(pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), budget)
        return pdf.assign(passes=passes, source_size=words, target=float(target))[
            ["no_source", "source", "size", "first", "extra", "passes", "source_size", "target"]
        ]

    plan = hist.groupBy("no_source", "source").applyInPandas(
        fit, "no_source boolean, source string, size long, first long, extra long, passes long, source_size long, target double"
    )
    plan = settle(plan.withColumnRenamed("source", "p_source").withColumnRenamed("no_source", "p_none").withColumnRenamed("size", "p_size"), "mix-plan")
    same = (rows["no_source"] == plan["p_none"]) & rows["source"].eqNullSafe(plan["p_source"]) & (rows["size"] == plan["p_size"])
    copies = F.col("passes") + F.when(F.col("idx") - F.col("first") < F.col("extra"), 1).otherwise(0)
    return (
        rows.join(plan, same)
        .withColumn("copies", copies.cast("long"))
        .select("id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *(["doc"] if keep else []))
    )
