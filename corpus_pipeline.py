"""A training-data pipeline: five stages, each written as Parquet and reread by the next.

Language identification rejects documents in no learned language; near duplicates (five-word
shingles, similarity 0.8) leave the smallest identifier of each group; documents that leak a
benchmark item go; sources are mixed to their target weights; the mix is packed into 24 shards.

A document that the mix takes twice is two rows from there on.  What each stage does with nulls,
repeated rows and other odd input is stated in ``lexharbor/llm/stages.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexharbor.llm.common import remove_path, scratch, scratch_scope
from lexharbor.llm.stages import decontamination, language, mixture, near_duplicates, sharding

STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("sharding", sharding),
]

#: Trained models, latent retrieval and packing are not SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; only the last one's table is left in the shared folder."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
