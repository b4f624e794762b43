"""A corpus cleaning pipeline: stages over ``documents``, each an operator.

Toxicity, SimHash near-dedup, repeated byte strings, benchmark leaks, and
SentencePiece ids.

Every stage reads what its predecessor wrote as Parquet below the session's
shared checkpoint folder; these files go when the stage's own are written. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import stages
from daybook.session import remove_location, scratch_location

STAGES = stages.STAGES

#: SQL has no zstandard, no XXH64 and no tokenizer: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        at = scratch_location(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
        if before:
            remove_location(spark, before)
        before = at
    return docs
