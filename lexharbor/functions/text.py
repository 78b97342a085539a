"""String functions, all as Column -> Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, as a regex class.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"

# Words that titles are compared without.
STOPWORDS = tuple(
    sorted(
        set(
            """
    a an and are as at be by for from has have if in into is it of on or
    that the to was were will with within without via using based study
    studies analysis investigation review report paper article note
    le la les des du de du d et un une et e o de da das dos
    el los las y o en al der die das und des den von zu im
    o a os as e do
    """.split()
        )
    )
)
# Function words that tell a title's language, at least two of one set.
FRENCH_WORDS = r"les|une|du|des|dans|sur|entre|avec|sont|est|étude"
GERMAN_WORDS = r"der|die|das|und|für|bei|von|zur|eines|einer|durch|über"
PORTUGUESE_WORDS = r"da|do|dos|das|para|com|análise|estudo|grãos?"


def trim_ws(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def collapse_ws(c: Column) -> Column:
    return trim_ws(F.regexp_replace(c, f"{WS}+", " "))


def blank_to_null(c: Column) -> Column:
    """Null for null, blank and the text ``nan`` (what a re-read missing cell looks like)."""
    t = trim_ws(c)
    return F.when((t == "") | (F.lower(t) == "nan"), F.lit(None)).otherwise(t)


def normalize_doi(c: Column) -> Column:
    """Lower case, without one of the URL or scheme prefixes; empty is null."""
    return F.nullif(F.regexp_replace(F.lower(trim_ws(c)), r"^(https://doi\.org/|http://doi\.org/|doi\.org/|doi:)", ""), F.lit(""))


def bare_doi(c: Column) -> Column:
    """The lookup form: the https prefix, then the scheme, go; case stays."""
    return F.regexp_replace(F.regexp_replace(trim_ws(F.coalesce(c, F.lit(""))), r"^https://doi\.org/", ""), r"^(?i)doi:", "")


def title_tokens(c: Column) -> Column:
    """Distinct tokens of a title without stopwords and single letters."""
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("([a-z0-9À-ɏЀ-ӿ]+)"), F.lit(1))
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    return F.filter(F.array_except(found, stop), lambda t: F.length(t) > 1)


def snippet(c: Column, n: int = 400) -> Column:
    s = collapse_ws(F.coalesce(c, F.lit("")))
    return F.concat(F.substring(s, 1, n), F.when(F.length(s) > n, "…").otherwise(""))


def strip_markup(c: Column) -> Column:
    """Text at nesting depth 0 of ``<`` and ``>``: the pieces between brackets that stand at depth 0.

    Outside of all brackets, ``>`` alone opens nothing and a last ``<`` without an end hides the rest.
    """
    text = F.coalesce(c, F.lit(""))
    pieces = F.regexp_extract_all(text, F.lit("([<>]|[^<>]+)"), F.lit(1))
    zero = F.struct(F.lit(0).alias("d"), F.lit("").alias("o"))

    def step(a: Column, p: Column) -> Column:
        depth = F.when(p == "<", a["d"] + 1).when(p == ">", F.greatest(a["d"] - 1, F.lit(0))).otherwise(a["d"])
        out = F.when(~p.isin("<", ">") & (a["d"] == 0), F.concat(a["o"], p)).otherwise(a["o"])
        return F.struct(depth.alias("d"), out.alias("o"))

    # Innermost pairs first: without nesting, one replacement leaves no bracket, and no fold is needed.
    flat = F.regexp_replace(text, "<[^<>]*>", "")
    return collapse_ws(F.when(flat.rlike("[<>]"), F.aggregate(pieces, zero, step, lambda a: a["o"])).otherwise(flat))


def strip_tags(c: Column) -> Column:
    """Tags become spaces (a plain pattern, unlike strip_markup)."""
    return collapse_ws(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " "))


def last_segment(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def native_id(c: Column) -> Column:
    """The identifier without the works-index prefix."""
    s = trim_ws(F.coalesce(c, F.lit("")))
    return F.when(s.startswith("https://openalex.org/"), last_segment(s)).otherwise(s)


def candidate_keys(record_id: Column, doi: Column) -> Column:
    """Ordered keys under which a cache may know a record."""
    s = F.nullif(trim_ws(F.coalesce(record_id, F.lit(""))), F.lit(""))
    d = F.nullif(F.lower(bare_doi(doi)), F.lit(""))
    return F.array_compact(F.array(s, F.when(F.contains(s, F.lit("/")), last_segment(s)), d, F.concat(F.lit("doi:"), d)))


def join_list(c: Column) -> Column:
    return F.coalesce(F.array_join(c, "; "), F.lit(""))


def row_text(title: Column, short: Column, abstract: Column) -> Column:
    """Title and the first of the short and the full abstract."""
    real = lambda c: F.nullif(F.nullif(c, F.lit("")), F.lit("nan"))
    return trim_ws(F.concat_ws(" ", real(title), F.coalesce(real(short), real(abstract))))


def label_prompt(title: Column, language: Column, tags: Column, abstract: Column, short: Column) -> Column:
    clean = lambda c: trim_ws(F.coalesce(c, F.lit("")))
    full = F.coalesce(F.nullif(F.nullif(clean(abstract), F.lit("nan")), F.lit("")), F.nullif(F.nullif(clean(short), F.lit("nan")), F.lit("")))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("TITLE: "), clean(title)),
        F.when(clean(language) != "", F.concat(F.lit("LANGUAGE: "), clean(language))),
        F.when(clean(tags) != "", F.concat(F.lit("MINERALS_DETECTED_BY_REGEX: "), clean(tags))),
        F.concat(F.lit("ABSTRACT: "), F.coalesce(full, F.lit("(none)"))),
    )


def short_label(c: Column, most: int = 60) -> Column:
    first = F.element_at(F.split(c, r"\. ", 2), 1)
    return F.when(F.length(first) > most, F.concat(F.substring(first, 1, most - 1), F.lit("…"))).otherwise(first)


def _bounded(words: str) -> str:
    return rf"(?<![\p{{L}}\p{{N}}_])({words})(?![\p{{L}}\p{{N}}_])"


def infer_language(title: Column) -> Column:
    """Script first, then two distinct function words of one language, else English; null stays null."""
    low = F.lower(title)
    hits = lambda words: F.size(F.array_distinct(F.regexp_extract_all(low, F.lit(_bounded(words)), F.lit(1))))
    return (
        F.when(title.isNull() | (title == ""), F.lit(None))
        .when(title.rlike("[Ѐ-ӿ]"), "ru")
        .when(title.rlike("[一-鿿ぁ-ヿ]"), "zh")
        .when(hits(GERMAN_WORDS) >= 2, "de")
        .when(hits(PORTUGUESE_WORDS) >= 2, "pt")
        .when(hits(FRENCH_WORDS) >= 2, "fr")
        .otherwise("en")
    )


def _quote(surface: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+?^$|-/" else c for c in surface)


def vocab_tags(text: Column, vocab: Mapping[str, Sequence[str]]) -> Column:
    """Tags, in vocabulary order, with a surface form in ``text`` as whole words, any case."""
    cases = [
        F.when(text.rlike("(?iu)" + _bounded("|".join(_quote(s) for s in surfaces))), F.lit(tag)) for tag, surfaces in vocab.items() if surfaces
    ]
    return F.array_compact(F.array(*cases)) if cases else F.array().cast("array<string>")


def haystack(title: Column, abstract: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(abstract, F.lit("")))


def year_prefix(c: Column) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"^(\d{4})", 1), F.lit("")).try_cast("int")


def year_token(c: Column, low: int | None = None, high: int | None = None) -> Column:
    """The first token that is four digits, optionally within bounds."""
    four = F.filter(F.split(F.coalesce(c, F.lit("")), f"{WS}+"), lambda t: t.rlike(r"^\d{4}$"))
    years = F.transform(four, lambda t: t.cast("int"))
    if low is not None:
        years = F.filter(years, lambda y: (y >= low) & (y <= high))
    return F.get(years, F.lit(0))


def raw_file_name(source: Column, query: Column) -> Column:
    """File name of a raw response: source, a readable part of the query, and a digest."""
    safe = F.substring(trim_ws(F.regexp_replace(query, r"[^A-Za-z0-9_.\-]+", "_")), 1, 60)
    return F.concat(source, F.lit("__"), safe, F.lit("__"), F.substring(F.sha1(query.cast("binary")), 1, 10), F.lit(".json"))
