"""Counts, quantiles and coverage reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import short_label
from ._storage import saved
from .selection import select_places


def value_counts(df: DataFrame, col: str, null_as: str | None = None, keep_null: bool = False) -> DataFrame:
    """(value, n); nulls are dropped unless named or kept."""
    v = F.coalesce(F.col(col).cast("string"), F.lit(null_as)) if null_as is not None else F.col(col).cast("string")
    out = df.select(v.alias("value"))
    return (out if keep_null else out.where("value is not null")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def quantiles(df: DataFrame, col: str, shares: Mapping[str, float], by: str | None = None) -> DataFrame:
    """n, min, max and the named shares (interpolated linearly) of ``col``, for each ``by`` if given.

    Places are found by counting (``selection``): the table is written once and not sorted, and no task
    holds the values of a group.  Nulls are left out; a group without values has no row, and neither
    has an empty table if ``by`` is given.
    """
    group = F.struct((F.col(by) if by else F.lit(0)).alias("g")).alias("g")
    values = saved(df.where(F.col(col).isNotNull()).select(group, F.col(col).alias("v"), F.rand(0).alias("u")), "quantile-values")
    groups = saved(values.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("min"), F.max("v").alias("max")), "quantile-groups")
    place = {name: F.lit(float(share)) * (F.col("n") - 1) for name, share in shares.items()}
    spots = [c for p in place.values() for c in (F.floor(p), F.ceil(p))]
    wanted = groups.select("g", F.explode(F.array_distinct(F.array(*spots))).alias("place"))
    near = select_places(values, wanted).groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("place", "v"))).alias("_near"))

    def value(p: Column) -> Column:
        low, high = F.floor(p), F.ceil(p)
        at = lambda c: F.element_at("_near", c)
        return F.when(low == high, at(low)).otherwise((high - p) * at(low) + (p - low) * at(high))

    out = groups.join(near, "g")
    return out.select(*([F.col("g.g").alias(by)] if by else []), "n", "min", "max", *[value(p).alias(name) for name, p in place.items()])


def score_stats(df: DataFrame, col: str = "embed_score") -> DataFrame:
    """n, min, median, p75, p90, max, and how many reach p75; one row, also without scores."""
    stats = quantiles(df, col, {"median": 0.5, "p75": 0.75, "p90": 0.9})
    stats = df.sparkSession.range(1).drop("id").join(stats, F.lit(True), "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))  # one row
    above = df.where(F.col(col).isNotNull()).join(F.broadcast(stats.select("p75")), F.col(col) >= F.col("p75")).agg(F.count(F.lit(1)).alias("n_p75"))
    return stats.select("n", "min", "median", "p75", "p90", "max").crossJoin(above)  # one row each


def anchor_coverage(df: DataFrame, anchors: DataFrame, min_score: float = 0.45) -> DataFrame:
    """A row for each anchor, also without records: n, median, p10, p90, max of the scores above the limit."""
    s = quantiles(df.where(F.col("embed_score") >= min_score), "embed_score", {"median": 0.5, "p10": 0.1, "p90": 0.9}, "embed_top_anchor")
    s = s.select(F.col("embed_top_anchor").alias("anchor_idx"), "n", "median", "p10", "p90", "max")
    return anchors.select("anchor_idx").join(s, "anchor_idx", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))


def global_totals(df: DataFrame, min_score: float = 0.45) -> DataFrame:
    s = df.where("embed_score is not null")
    above = F.count_if(F.col("embed_score") >= min_score)
    return s.agg(F.count(F.lit(1)).alias("n"), above.alias("n_above"), (100.0 * above / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("percent_above"))


def anchor_topk(df: DataFrame, k: int = 3, min_score: float = 0.45, order: str = "ord") -> DataFrame:
    w = Window.partitionBy("embed_top_anchor").orderBy(F.col("embed_score").desc(), F.col(order))
    return df.where(F.col("embed_score") >= min_score).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def coverage_fraction(df: DataFrame, col: str = "source_databases"):
    return df.agg(F.avg((F.coalesce(F.col(col), F.lit("")) != "").cast("double")).alias("covered"))


def check_source_coverage(main: DataFrame, merged: DataFrame) -> str | None:
    """A message if provenance collapsed in a merge: at least half before, under a fifth after."""
    if "source_databases" not in main.columns:
        return None
    before = coverage_fraction(main).first()["covered"] or 0.0
    after = coverage_fraction(merged).first()["covered"] or 0.0 if "source_databases" in merged.columns else 0.0
    if before >= 0.5 and after < 0.2:
        return f"source coverage collapsed in the merge: {before:.0%} before, {after:.0%} after"
    return None


def markdown_report(df: DataFrame, anchors: DataFrame, min_score: float = 0.45, k: int = 3, labels: dict[int, str] | None = None, order: str = "ord") -> str:
    """The coverage table and the best records of each anchor; a few rows reach the driver."""
    names = labels or {r[0]: r[1] for r in anchors.select("anchor_idx", short_label(F.col("text"))).collect()}
    t = global_totals(df, min_score).first()
    st = quantiles(df, "embed_score", {"median": 0.5}).select("min", "max", "median").first() or (None, None, None)
    num = lambda x: "—" if x is None else f"{x:.3f}"
    lines = [
        "# Anchor coverage",
        f"\nRecords with a score: **{t['n']}** (range {num(st[0])} to {num(st[1])}, median {num(st[2])})",
        f"\nAt least {min_score}: **{t['n_above']} of {t['n']} ({t['percent_above']:.1f}%)**\n",
        "| # | Anchor | N | median | p10 | p90 | max |",
        "|---|---|--:|--:|--:|--:|--:|",
    ]
    rows = {r["anchor_idx"]: r for r in anchor_coverage(df, anchors, min_score).collect()}
    for i in sorted(names):
        r = rows.get(i)
        cells = [num(r[c]) if r and r["n"] else "—" for c in ("median", "p10", "p90", "max")]
        lines.append(f"| {i} | {names[i]} | {r['n'] if r else 0} | " + " | ".join(cells) + " |")
    lines.append(f"\n## Best {k} records of each anchor")
    cols = [c for c in ("year", "title") if c in df.columns]
    best = anchor_topk(df, k, min_score, order).select("embed_top_anchor", "rank", "embed_score", *cols).collect()
    for i in sorted(names):
        own = sorted((r for r in best if r["embed_top_anchor"] == i), key=lambda r: r["rank"])
        lines.append(f"\n### [{i}] {names[i]}")
        lines += ["", "_(none above the limit)_"] if not own else [
            f"- `{r['embed_score']:.3f}`{' ' + str(r['year']) if 'year' in cols and r['year'] is not None else ''} — {((r['title'] if 'title' in cols else '') or '').strip()[:90]}" for r in own
        ]
    return "\n".join(lines)
