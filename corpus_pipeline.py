"""Five-stage corpus pipeline over ``documents``: quality, near copies, benchmark passages, secrets, packing.

Each stage gets the documents that its predecessor kept, reread from Parquet, and all
but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import stages
from tidemark.llm.common import stored, table

STAGES = [
    ("quality", stages.good_quality),
    ("near_duplicates", stages.one_of_each_group),
    ("decontamination", stages.without_benchmark),
    ("secrets", stages.without_secrets),
    ("packing", stages.packed),
]

#: Trained scores, hashing and tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
