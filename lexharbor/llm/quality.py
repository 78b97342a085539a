"""Quality rules: an ordered decision list learned by sequential covering (DataFrame functions only).

1. **Statistics.**  Every whole text gives the counts and shares of ``STATISTICS``; they are Spark
   expressions over the text, so no row leaves the JVM and nothing is shuffled.
2. **Learning.**  At most ``FIT_ROWS`` labelled rows, drawn by a hash of the identifier, reach the
   driver as numbers.  Rules for low quality are found one after another: a conjunction grows by the
   threshold with the largest information gain on two thirds of the rows, loses conditions from its
   end as long as that does not make it worse on the other third, and is kept if it is right there
   for ``PRECISION`` of the rows that it covers; what it covers is put aside for the next one, and what
   a rejected rule was grown for is put aside too.
3. **Verdict.**  The list becomes one ordered ``CASE``: the first rule that holds names the verdict, a
   text that no rule covers is kept.

The base rule (fewer than ``LEAST_WORDS`` words, or over ``MOST_REPEATED`` percent of the words in
repeated windows) comes before the list.

A window is ``WINDOW`` words in a row.  Texts whose windows have different hashes repeat none; the
windows of the others are compared word by word, so equal hashes alone decide nothing.

Defined results: null, empty and blank texts have no words and fail the base rule; shares of nothing
are 0; repeated rows get the same numbers; ties between thresholds go to the first statistic and the
lowest threshold; labels that are null or name no text are not learned from, and without labels of
both kinds the list is empty; very long texts are judged whole (one row's arrays grow with its words);
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN

#: The base rule, and the length of a window (fixed values).
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
SYMBOLS, SPACES = "[#*$%&|<>]+", " \t\n\x0b\x0c\r"
#: Labelled rows that are learned from at most; candidate thresholds of a statistic.
FIT_ROWS, THRESHOLDS = 4096, 64
#: A rule's least precision and covered rows on rows that it was not grown on, conditions, rules and rejected rules at most.
PRECISION, COVERED, CONDITIONS, RULES, ATTEMPTS = 0.95, 3, 4, 16, 16

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars", "n_upper", "n_letters", "n_digits", "n_distinct", "n_marks"]
#: Statistics of the rules: (name, count, what it is a share of).
STATISTICS = [
    ("words", "n_words", None), ("word_length", "word_chars", "n_words"), ("symbols_per_word", "n_symbols", "n_words"),
    ("dup_line_share", "n_dup_lines", "n_lines"), ("repeat_share", "n_repeat_words", "n_words"), ("words_per_line", "n_words", "n_lines"),
    ("upper_share", "n_upper", "n_letters"), ("letter_share", "n_letters", "n_chars"), ("digit_share", "n_digits", "n_chars"),
    ("distinct_share", "n_distinct", "n_words"), ("marks_per_word", "n_marks", "n_words"),
]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside other functions."""
    return F.transform(F.array(value), body)[0]


def _neighbours_equal(rows: Column, same: Callable[[Column, Column], Column]) -> Column:
    """The elements of a sorted array that equal the one before or after them."""
    return F.filter(rows, lambda x, i: F.coalesce(same(F.get(rows, i - 1), x), F.lit(False)) | F.coalesce(same(F.get(rows, i + 1), x), F.lit(False)))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words of an array that lie in windows found twice or more, the first included."""

    def hashes(h: Column) -> Column:
        """A hash of each window, from those of its words."""
        return F.transform(F.sequence(F.lit(0), F.size(h) - window), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]))

    def covered(places: Column) -> Column:
        ends = F.concat(F.slice(places, F.lit(2), F.size(places)), F.array(F.lit(1 << 30)))
        return F.aggregate(F.zip_with(places, ends, lambda a, b: F.least(b - a, F.lit(window))), F.lit(0), lambda n, x: n + x)

    def compared(found: Column) -> Column:
        """``found`` has (hash, place); the windows of equal hashes are compared as text."""
        texts = F.array_sort(F.transform(found, lambda x: F.struct(F.array_join(F.slice(words, x["at"] + 1, F.lit(window)), " ").alias("text"), x["at"].alias("at"))))
        places = let(texts, lambda t: F.transform(_neighbours_equal(t, lambda a, b: a["text"] == b["text"]), lambda x: x["at"]))
        return let(F.array_sort(places), covered)

    def counted(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("hash"), i.alias("at"))))
        again = let(placed, lambda p: _neighbours_equal(p, lambda a, b: a["hash"] == b["hash"]))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(again, compared))

    found = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(hashes(h), counted))
    return F.when(F.size(words) > window, found).otherwise(F.lit(0))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the counts, the shares) of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.btrim(F.col("text"), F.lit(SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))
    lines = F.filter(F.split(F.col("text"), "\n"), lambda s: F.btrim(s, F.lit(SPACES)) != "")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    rows = rows.withColumn("words", words).withColumn("lines", lines)
    t = F.col("text")
    matched = lambda pattern: F.length(t) - F.length(F.regexp_replace(t, pattern, ""))
    rows = rows.select(
        "id",
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        matched(SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        let(F.col("words"), lambda w: repeated_words(w)).alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        F.length(t).alias("n_chars"),
        matched(r"\p{Lu}+").alias("n_upper"),
        matched(r"\p{L}+").alias("n_letters"),
        matched(r"[0-9]+").alias("n_digits"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        matched("[!?]+").alias("n_marks"),
    )
    rows = rows.select("id", *[F.col(c).cast("long").alias(c) for c in COUNTS])
    share = lambda n, of: F.round(F.col(n) / F.greatest(F.col(of), F.lit(1)), 6) if of else F.col(n).cast("double")
    return rows.select("*", *[share(n, of).alias(name) for name, n, of in STATISTICS])


# ------------------------------------------------------------------ learning
@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.statistic] >= self.threshold if self.above else row[self.statistic] < self.threshold

    def column(self) -> Column:
        c = F.col(self.statistic)
        return c >= F.lit(self.threshold) if self.above else c < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.above else '<'} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, rows: list[dict]) -> list[dict]:
    return [r for r in rows if all(c.holds(r) for c in rule)]


def _bad(rows: list[dict]) -> int:
    return sum(r["low"] for r in rows)


def _cuts(rows: list[dict], name: str) -> list[float]:
    """Thresholds between different values, evenly over the ranks, and around each value of a bad row."""
    values = sorted(r[name] for r in rows)
    between = sorted({round((a + b) / 2, 6) for a, b in zip(values, values[1:], strict=False) if a < b})
    if len(between) <= THRESHOLDS:
        return between
    return [between[i * (len(between) - 1) // (THRESHOLDS - 1)] for i in range(THRESHOLDS)]


def _grown(rows: list[dict]) -> Rule:
    """Add the condition of the largest information gain until the covered rows are all bad."""
    rule: Rule = ()
    while len(rule) < CONDITIONS and 0 < _bad(rows) < len(rows):
        p, n = _bad(rows), len(rows)
        best, gain = None, 1e-9
        for name, _, _ in STATISTICS:
            ordered = sorted((r[name], r["low"]) for r in rows)
            below, low, k = 0, 0, 0
            for cut in _cuts(rows, name):
                while k < n and ordered[k][0] < cut:
                    below, low, k = below + 1, low + ordered[k][1], k + 1
                for above, hit, size in ((False, low, below), (True, p - low, n - below)):
                    got = hit * (log2(hit / size) - log2(p / n)) if hit else 0.0
                    if got > gain:
                        best, gain = Condition(name, above, cut), got
        if best is None:
            break
        rule, rows = (*rule, best), [r for r in rows if best.holds(r)]
    return rule


def _pruned(rule: Rule, rows: list[dict]) -> Rule:
    """The shortest beginning of ``rule`` that is worth most on rows that it was not grown on."""

    def worth(k: int) -> float:
        hit = _covered(rule[:k], rows)
        return (2 * _bad(hit) - len(hit)) / len(hit) if hit else -1.0

    return rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))] if rule else rule


def _tightest(rule: Rule) -> Rule:
    """``rule`` without conditions that a later one on the same side of the statistic implies."""
    last = {(c.statistic, c.above): c for c in rule}
    return tuple(c for c in rule if last[(c.statistic, c.above)] is c)


def learn_rules(rows: list[dict], precision: float = PRECISION) -> list[Rule]:
    """Ordered rules for ``low`` rows: dicts of the statistics with ``low`` 0 or 1, in a fixed order."""
    grow, prune, rules = [r for i, r in enumerate(rows) if i % 3], [r for i, r in enumerate(rows) if i % 3 == 0], []
    tried = 0
    while len(rules) < RULES and _bad(grow) and _bad(prune):
        grown = _grown(grow)
        rule = _pruned(grown, prune)
        hit = _covered(rule, prune)
        if not rule or tried == ATTEMPTS:
            break
        if len(hit) < COVERED or _bad(hit) < precision * len(hit):
            # Not worth keeping: what it was grown for is put aside, and the next one is grown for the rest.
            tried, grow = tried + 1, [r for r in grow if not (r["low"] and all(c.holds(r) for c in grown))]
            continue
        rules.append(_tightest(rule))
        grow, prune = ([r for r in part if not all(c.holds(r) for c in rule)] for part in (grow, prune))
    return rules


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", good: int = 1, rows: int = FIT_ROWS) -> list[Rule]:
    """Rules learned from at most ``rows`` labelled rows, drawn by a hash of the identifier."""
    draw = F.xxhash64(F.lit("quality"), "l_id")
    drawn = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("l_id")).agg(F.min(F.col(label_col)).alias("label"))
    drawn = drawn.where("l_id is not null").orderBy(draw, "l_id").limit(rows)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    told = statistics(texts.join(F.broadcast(drawn.select("l_id")), F.col("id") == F.col("l_id"), "left_semi"), "id", "text")
    told = told.join(F.broadcast(drawn), F.col("id") == F.col("l_id"))  # at most ``rows`` labels
    names = [name for name, _, _ in STATISTICS]
    order = [F.xxhash64(F.lit("quality"), "id"), F.col("id"), *names]
    got = told.select("id", (F.col("label") != good).cast("int").alias("low"), *names).orderBy(*order).limit(rows).collect()
    return learn_rules([r.asDict() for r in got])


def verdict(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that holds, null where none does."""
    out = None
    for i, rule in enumerate(rules, 1):
        holds = rule[0].column()
        for c in rule[1:]:
            holds = holds & c.column()
        out = F.when(holds, F.lit(i)) if out is None else out.when(holds, F.lit(i))
    return F.lit(None).cast("int") if out is None else out


def quality_rules(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """(id, the counts, the shares, base_failed, rule, reason, kept) of every row."""
    if rules is None:
        rules = fit(docs, labels, id_col, text_col) if labels is not None else []
    rows = statistics(docs, id_col, text_col)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    said = F.get(F.array(*[F.lit(" and ".join(map(str, r))) for r in rules]), F.col("rule") - 1) if rules else F.lit(None).cast("string")
    rows = rows.withColumn("base_failed", failed).withColumn("rule", verdict(rules))
    return rows.withColumn("reason", F.when(F.col("base_failed"), "base").otherwise(said)).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
