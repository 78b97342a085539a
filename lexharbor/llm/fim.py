"""Fill-in-middle transformation with a sparse checkpoint index.

A text of n units (lines or characters) is cut twice, after a seeded number of units each.  Counting
the units records a checkpoint, its byte and code-point offset, after every ``every`` of them; a cut
is found by a binary search of the checkpoints and a rescan of fewer than ``every`` units.  So a text
is read once however long it is, and beside it only n / ``every`` checkpoints are held.

Only cuts come back from Python: texts are cut and put together by Spark.  The output is the text
itself (``plain``), ``<P>prefix<S>suffix<M>middle`` (``psm``) or ``<S>suffix<P>prefix<M>middle``
(``spm``).  A text that holds a mark stays plain, so the marks of an output are never ambiguous and
``restored`` gives the exact text back.

Defined results: null and empty texts have no units and are plain; cuts depend on the seed, the
identifier and the number of units alone, so repeated rows are cut alike; a null identifier is
hashed as the empty text; cuts may coincide or lie at either end (empty parts); a line keeps its
``\\n``, and ``\\r`` is a character like others; very long texts are scanned in blocks; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tune

#: Units between checkpoints, and bytes that are scanned at once.
EVERY, SCAN_BYTES = 256, 1 << 20
#: Marks of prefix, suffix and middle (fixed values).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUTS = "n long, prefix_bytes long, prefix_chars long, middle_bytes long, middle_chars long"


@dataclass
class Checkpoints:
    """Units of one text: their number, and the offsets after every ``every`` units."""

    raw: bytes
    unit: str
    n: int
    chars: int
    units: list[int]
    byte_at: list[int]
    char_at: list[int]

    def cut(self, units: int) -> tuple[int, int]:
        """(byte, code point) where the first ``units`` units end."""
        if units >= self.n:
            return len(self.raw), self.chars
        k = bisect_right(self.units, units) - 1
        at, left = self.byte_at[k], units - self.units[k]
        start = at
        if self.unit == "line":
            for _ in range(left):
                at = self.raw.index(b"\n", at) + 1
            return at, self.char_at[k] + _starts(self.raw, start, at)
        while left or (at < len(self.raw) and self.raw[at] & 0xC0 == 0x80):
            left -= (self.raw[at] & 0xC0) != 0x80
            at += 1
        return at, self.char_at[k] + units - self.units[k]


def _starts(raw: bytes, a: int, b: int) -> int:
    """Code points that start in raw[a:b]."""
    return int(np.count_nonzero((np.frombuffer(raw, np.uint8, b - a, a) & 0xC0) != 0x80)) if b > a else 0


def checkpoints(text: str | None, unit: str = "line", every: int = EVERY) -> Checkpoints:
    """Count the units of ``text`` and index them on the way."""
    raw = (text or "").encode("utf-8")
    units, byte_at, char_at, n, chars = [0], [0], [0], 0, 0
    for a in range(0, len(raw), SCAN_BYTES):
        block = np.frombuffer(raw, np.uint8, min(SCAN_BYTES, len(raw) - a), a)
        starts = (block & 0xC0) != 0x80
        # Where units end: after a line's end, or before the next character's first byte.
        ends = np.flatnonzero(block == 10) + 1 if unit == "line" else np.flatnonzero(starts)
        before = n if unit == "line" else n - 1  # the first character starts where none ends
        first = every - before % every - 1  # index in ``ends`` of the next checkpoint
        marks = ends[first::every]
        if len(marks):
            seen = np.concatenate([[0], np.cumsum(starts)])[marks]
            for j, (byte, char) in enumerate(zip(marks.tolist(), seen.tolist(), strict=True)):
                units.append(before + first + 1 + j * every)
                byte_at.append(a + byte)
                char_at.append(chars + char)
        n += len(ends)
        chars += int(np.count_nonzero(starts))
    if unit == "line" and raw and not raw.endswith(b"\n"):
        n += 1
    return Checkpoints(raw, unit, n, chars, units, byte_at, char_at)


def cuts_of(text: str | None, h1: int, h2: int, unit: str = "line", every: int = EVERY) -> tuple[int, int, int, int, int]:
    """(n, prefix bytes, prefix characters, middle bytes, middle characters)."""
    index = checkpoints(text, unit, every)
    one, two = sorted((h1 % (index.n + 1), h2 % (index.n + 1)))
    (b1, c1), (b2, c2) = index.cut(one), index.cut(two)
    return index.n, b1, c1, b2 - b1, c2 - c1


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    part = lambda i: F.element_at(F.split(output, "<[PSM]>", -1), i)
    return F.when(form == "psm", F.concat(part(2), part(4), part(3))).when(form == "spm", F.concat(part(3), part(4), part(2))).otherwise(output)


def fill_in_middle(
    docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, unit: str = "line", every: int = EVERY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, prefix_bytes, middle_bytes, output) for every row.

    ``rate`` percent of the texts are transformed, ``spm`` percent of them suffix first; offsets are
    null for plain texts.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unknown unit {unit}")
    tune(docs.sparkSession)

    @F.pandas_udf(CUTS)
    def cuts(text: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
        rows = [cuts_of(t, a, b, unit, every) for t, a, b in zip(text, h1.tolist(), h2.tolist(), strict=True)]
        return pd.DataFrame(rows, columns=["n", "prefix_bytes", "prefix_chars", "middle_bytes", "middle_chars"], dtype="int64")

    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), *[h[i].alias(f"h{i + 1}") for i in range(4)])
    rows = rows.withColumn("cuts", cuts("text", "h1", "h2"))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= rate)
    rows = rows.withColumn("form", F.when(plain, "plain").when(F.col("h4") % 100 < spm, "spm").otherwise("psm"))
    p, m = F.col("cuts.prefix_chars").cast("int"), F.col("cuts.middle_chars").cast("int")
    prefix, middle, suffix = (F.substring("text", *a) for a in ((F.lit(1), p), (p + 1, m), (p + m + 1, F.length("text"))))
    output = (
        F.when(F.col("form") == "plain", F.col("text"))
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    offsets = [F.when(F.col("form") != "plain", F.col(f"cuts.{c}")).alias(c) for c in ("prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes")]
    return rows.select("id", F.col("cuts.n").alias("n"), "form", *offsets, output.alias("output"))
