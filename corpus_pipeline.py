"""Corpus pipeline over ``documents``: each stage works on what the one before kept.

Quality rules drop rejected documents; the n-gram join keeps one document of each near-duplicate group;
decontamination drops documents with benchmark passages; the secret scan replaces secrets in the texts;
packing returns the pieces of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerflow.llm.decontam import decontam_stage
from layerflow.llm.ngram_join import near_duplicates_stage
from layerflow.llm.packing import packing_stage
from layerflow.llm.quality import quality_stage
from layerflow.llm.secret_scan import secrets_stage
from layerflow.session import scratch_dir

STAGES = [
    ("quality rules", quality_stage),
    ("n-gram join", near_duplicates_stage),
    ("benchmark decontamination", decontam_stage),
    ("secret scan", secrets_stage),
    ("packing", packing_stage),
]

#: No SQL: packing has none.  tests/llm/test_pipeline.py holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage keeps is a table below the shared folder, so the next one, which may
    read it more than once, does not compute it again."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
