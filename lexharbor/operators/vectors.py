"""Vectors against anchors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Anchors are configuration: more than this is refused rather than put into expressions.
MAX_ANCHORS = 4096


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def unit(v: Column) -> Column:
    """Scaled to length 1; the zero vector stays.  The one-element array binds the norm once."""
    scaled = F.transform(F.array(norm(v)), lambda n: F.transform(v, lambda x: x.cast("double") / F.when(n == 0, 1.0).otherwise(n)))
    return F.get(scaled, F.lit(0))


def checked(df: DataFrame, size: int, col: str = "embedding") -> DataFrame:
    """Fail where a vector has another length."""
    bad = F.raise_error(F.lit(f"a vector has not {size} values"))
    return df.withColumn(col, F.when(F.col(col).isNull() | (F.size(col) == size), F.col(col)).otherwise(bad.cast(df.schema[col].dataType)))


def score_anchors(df: DataFrame, anchors: DataFrame, col: str = "embedding") -> DataFrame:
    """Add embed_score (largest cosine, null without vector) and embed_top_anchor (first on ties, -1).

    One matrix product for each Arrow batch; the anchors travel with the function, their number is
    checked.  Cosines are rounded to nine digits, so that ties do not depend on the order of sums.
    """
    rows = anchors.orderBy("anchor_idx").select("embedding").limit(MAX_ANCHORS + 1).collect()
    if not 0 < len(rows) <= MAX_ANCHORS:
        raise ValueError(f"{len(rows)} anchors; 1 to {MAX_ANCHORS} are supported")

    def unit_rows(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(n == 0, 1, n)

    marks = unit_rows(np.array([r["embedding"] for r in rows], dtype=np.float64)).T

    def best(v: pd.Series) -> pd.DataFrame:
        has = v.notna().to_numpy()
        score, top = np.full(len(v), np.nan), np.full(len(v), -1)
        if has.any():
            sims = np.round(unit_rows(np.stack(v[has].to_list()).astype(np.float64)) @ marks, 9)
            score[has], top[has] = sims.max(axis=1), sims.argmax(axis=1)
        return pd.DataFrame({"score": pd.Series(score).astype("Float64").where(has), "anchor": top})

    both = F.pandas_udf(best, "score double, anchor int")(F.col(col))
    out = df.withColumn("_best", both)
    return out.withColumn("embed_score", F.col("_best.score")).withColumn("embed_top_anchor", F.col("_best.anchor")).drop("_best")
