"""HTML entities: the one string function without a built-in."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_tags


def _decoded(s: pd.Series) -> pd.Series:
    return s.map(lambda x: html.unescape(x) if isinstance(x, str) else None)


def unescape(c: Column) -> Column:
    """Entities decoded; text without ``&`` keeps its value."""
    decode = F.pandas_udf(_decoded, "string")
    return F.when(F.contains(c, F.lit("&")), decode(c)).otherwise(c)


def strip_tags_unescape(c: Column) -> Column:
    return unescape(strip_tags(c))
