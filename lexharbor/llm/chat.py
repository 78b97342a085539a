"""Chat formatting by perspective rotation (DataFrame functions only).

Every participant of a dialogue gets a view of it in which that speaker is the assistant and all
others are named users; only the assistant's words and end marks are trained on.  ``system`` turns
are instructions, not a participant, and stay what they are in every view.  A view is one row and one
training text, however long the dialogue is; only where ``piece_turns`` is given, it is cut into rows of
so many turn numbers, whose texts in order are the view.

Defined results: turns sort by (turn, speaker, text), null turn first, and repeated rows are
repeated turns; a null speaker is the participant ``unknown``; null text is empty; end marks inside
a text are escaped; a dialogue with system turns only has no view; turns without a ``conv_id`` are one
dialogue; very long texts are kept whole; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Marks of the rendered text (fixed values).
OPEN, CLOSE, ESCAPED = "<|im_start|>", "<|im_end|>", "<|im\\_"


def _safe(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|im_"), F.lit(ESCAPED))


def rotate_perspectives(turns: DataFrame, piece_turns: int | None = None) -> DataFrame:
    """(conv_id, perspective, piece, n_turns, text, masks): masks are [start, end) character spans."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.nullif(F.trim(F.regexp_replace(F.col("role"), r"[\r\n]+|<\|", " ")), F.lit("")), F.lit("unknown")).alias("speaker"),
        _safe(F.col("text")).alias("said"),
    )
    people = rows.where("speaker <> 'system'").select(F.col("conv_id").alias("c_id"), F.col("speaker").alias("perspective")).distinct()
    views = rows.join(people, F.col("conv_id").eqNullSafe(F.col("c_id")))
    own = F.col("speaker") == F.col("perspective")
    head = F.concat(
        F.lit(OPEN),
        F.when(F.col("speaker") == "system", "system").when(own, "assistant").otherwise(F.concat(F.lit("user name="), F.col("speaker"))),
        F.lit("\n"),
    )
    piece = F.coalesce(F.floor(F.col("turn") / piece_turns), F.lit(0)).cast("long") if piece_turns else F.lit(0).cast("long")
    views = views.select("conv_id", "perspective", piece.alias("piece"), "turn", "speaker", "said", head.alias("head"), F.concat(F.col("said"), F.lit(CLOSE)).alias("body"), own.alias("own"))
    # Where each turn starts: a running sum, so a long dialogue costs no more a turn than a short one.
    before = Window.partitionBy("conv_id", "perspective", "piece").orderBy("turn", "speaker", "said").rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("head") + F.length("body") + 1
    views = views.withColumn("at", F.coalesce(F.sum(length).over(before), F.lit(0)).cast("int"))
    turn = F.struct("at", "head", "body", "own")
    rows = views.groupBy("conv_id", "perspective", "piece").agg(F.sort_array(F.collect_list(turn)).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "")
    start = lambda p: p["at"] + F.length(p["head"])
    masks = F.transform(F.filter("parts", lambda p: p["own"]), lambda p: F.struct(start(p).alias("start"), (start(p) + F.length(p["body"])).alias("end")))
    return rows.select("conv_id", "perspective", "piece", F.size("parts").alias("n_turns"), text.alias("text"), masks.alias("masks"))
