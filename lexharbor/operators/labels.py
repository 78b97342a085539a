"""Model labels: parsing replies, error rows, checkpoints and joining."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nested import label_json
from ..schema import LABEL, LABEL_COLUMNS
from .resolve import last_by


def parse_label(reply: Column) -> Column:
    """The label of a reply, null where it is no JSON object; fields are typed, so "false" stays a text error."""
    text = label_json(reply)
    ok = F.try_parse_json(text).isNotNull() & text.startswith("{")
    return F.when(ok, F.from_json(text, LABEL))


def error_label(reason: Column) -> Column:
    err, none = F.lit("error"), F.array().cast("array<string>")
    return F.struct(
        err.alias("relevance"), err.alias("parent_lithology"), err.alias("process_focus"), err.alias("regolith_zone"), none.alias("methods"), none.alias("minerals"),
        F.lit("not_applicable").alias("climate_zone"), F.lit(False).alias("is_thesis"), F.lit(False).alias("is_review"), F.substring(reason, 1, 200).alias("rationale"),
    )


def label_columns(label: Column) -> list[Column]:
    """The ten output columns; lists joined by ``|``, missing flags are false."""
    out = []
    for field, name in zip(LABEL.fields, LABEL_COLUMNS, strict=True):
        c = label[field.name]
        kind = field.dataType.simpleString()
        c = F.coalesce(F.array_join(c, "|"), F.lit("")) if kind.startswith("array") else F.coalesce(c, F.lit(False)) if kind == "boolean" else F.coalesce(c, F.lit(""))
        out.append(c.alias(name))
    return out


def with_labels(df: DataFrame, reply: str = "reply", error: str | None = None) -> DataFrame:
    """Parse replies; rows without a usable one get the error label."""
    reason = F.col(error) if error else F.lit("unparseable reply")
    label = F.coalesce(parse_label(F.col(reply)), error_label(F.coalesce(reason, F.lit("unparseable reply"))))
    return df.withColumn("_label", label).select(*df.columns, *label_columns(F.col("_label")))


def last_checkpoint(log: DataFrame, key: str = "id", order: str = "chunk") -> DataFrame:
    """The append log's latest row of each key."""
    return last_by(log, key, order)


def join_labels(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join on the identifier as text, on both sides."""
    own = labels.withColumn("_id", F.col("id").cast("string")).drop("id")
    return df.join(own, df["id"].cast("string") == own["_id"], "left").drop("_id")


def gated(df: DataFrame, column: str) -> DataFrame:
    """Only rows whose gate column is true."""
    return df.where(F.col(column))
