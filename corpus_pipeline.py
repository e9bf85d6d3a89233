"""Training-data pipeline over documents: toxic documents go, then low-quality ones, then near copies;
what is left is mixed to target weights and encoded. Each stage's result is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import mixing, pieces, quality, similarity, toxicity
from textloom.llm.shared import Scratch

STAGES = [
    ("toxicity", toxicity.stage),
    ("quality", quality.stage),
    ("near_copies", similarity.stage),
    ("mixing", mixing.stage),
    ("encoding", pieces.stage),
]

ORACLE_SQL = None  # the first stages apply fitted models, which SQL cannot express


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over documents."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
