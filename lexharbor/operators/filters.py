"""Record filters, augmentation and ranking."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import haystack, normalize_doi, snippet, trim_ws, vocab_tags

# Record types that are dropped, and the names of English.
EXCLUDED_TYPES = ("paratext", "erratum", "editorial", "letter")
ENGLISH = ("en", "eng", "english")


def allowed_type(kind: Column) -> Column:
    return ~F.lower(F.coalesce(kind, F.lit(""))).isin(*EXCLUDED_TYPES)


def blocked_title(title: Column, block: Sequence[str]) -> Column:
    low = F.lower(F.coalesce(title, F.lit("")))
    hit = F.lit(False)
    for s in block:
        hit = hit | F.contains(low, F.lit(s))
    return hit


def spec_filter(df: DataFrame, block: Sequence[str] = ()) -> DataFrame:
    return df.where(allowed_type(F.col("type")) & ~blocked_title(F.col("title"), block))


def non_english(language: Column) -> Column:
    """Null is no; the empty text counts as another language."""
    return F.coalesce(~F.lower(language).isin(*ENGLISH), F.lit(False))


def priority_score(axes: Sequence[str], topic: str | None = None) -> Column:
    point = lambda cond, n: F.when(cond, n).otherwise(0)
    kind = F.lower(F.coalesce(F.col("type"), F.lit("")))
    score = point(F.col("non_english"), 3) + point(F.contains(kind, F.lit("thesis")) | F.contains(kind, F.lit("dissertation")), 2)
    for a in axes:
        score = score + point(F.size(F.col(a)) > 0, 1)
    if topic is not None:
        score = score + point(F.coalesce(F.col("title"), F.lit("")).rlike(topic), 1)
    return (score + point(F.col("cited_by_count") < 10, 1) + point(F.coalesce(F.col("open_access_url"), F.lit("")) != "", 1)).cast("int")


def augment(df: DataFrame, vocab: Mapping[str, Mapping[str, Sequence[str]]], gate: tuple[str, Callable[[Column], Column]] | None = None, topic: str | None = None) -> DataFrame:
    """Tags of each vocabulary axis (arrays), flags, snippet, constants and the priority score."""
    text = haystack(F.col("title"), F.col("abstract"))
    cols = {"non_english": non_english(F.col("language"))}
    cols |= {f"{axis}_mentioned": vocab_tags(text, tags) for axis, tags in vocab.items()}
    if gate is not None:
        cols[gate[0]] = gate[1](text)
    cols |= {"abstract_snippet": snippet(F.col("abstract")), "title_english_translation": F.lit(""), "notes": F.lit(""), "year": F.col("publication_year")}
    return df.withColumns(cols).withColumn("priority_score", priority_score([f"{a}_mentioned" for a in vocab], topic))


def ranked(df: DataFrame) -> DataFrame:
    """By priority, ties by identifier."""
    return df.orderBy(F.col("priority_score").desc(), F.col("id"))


def score_band(df: DataFrame, low: float = 0.45, high: float | None = None, col: str = "embed_score") -> DataFrame:
    df = df.where(F.col(col) >= low)
    return df if high is None else df.where(F.col(col) < high)


def missing_text(c: Column) -> Column:
    t = trim_ws(F.coalesce(c, F.lit("")))
    return (t == "") | (F.lower(t) == "nan")


def anti_join(df: DataFrame, key: Column, gone: DataFrame, col: str) -> DataFrame:
    """Rows whose ``key`` is not in ``gone``; rows without one stay and are not joined, or they would all meet in one task."""
    return df.where(key.isNotNull()).join(gone, key == F.col(col), "left_anti").unionByName(df.where(key.isNull()))


def exclude_dois(df: DataFrame, listed: DataFrame, col: str = "doi") -> DataFrame:
    """Left anti on the written form of the DOI, as the exclude list is compared un-normalised."""
    gone = listed.select(F.lower(trim_ws(F.col(col))).alias("_x")).where("_x <> ''").distinct()
    return anti_join(df, F.lower(trim_ws(F.col("doi"))), gone, "_x")


def not_present(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of ``new`` whose id and whose normalised DOI ``old`` lacks: two anti joins, never one OR."""
    dois = old.select(normalize_doi(F.col("doi")).alias("_d")).where("_d is not null").distinct()
    ids = old.select(F.col("id").alias("_i")).where("_i is not null").distinct()
    return anti_join(anti_join(new, F.col("id"), ids, "_i"), normalize_doi(F.col("doi")), dois, "_d")


def pending(df: DataFrame, cache: DataFrame, key: str = "id") -> DataFrame:
    return df.join(cache.select(key).distinct(), key, "left_anti")


def relevance(title: Column, abstract: Column, vocab: Mapping[str, Sequence[str]], only: str, block: Sequence[str] = ()) -> Column:
    """Screening bucket: blocked, off_topic, <only>_only, or non_<only>."""
    tags = vocab_tags(haystack(title, abstract), vocab)
    return (
        F.when(blocked_title(title, block), "blocked")
        .when(F.size(tags) == 0, "off_topic")
        .when((F.size(tags) == 1) & F.array_contains(tags, only), f"{only}_only")
        .otherwise(f"non_{only}")
    )


def available(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in columns if c in df.columns])
