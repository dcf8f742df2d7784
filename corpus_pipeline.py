"""From raw documents to token counts: language, near duplicates, personal data, mixture, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegraph.llm import stages
from tidegraph.llm._tables import materialise

STAGES = [
    ("language_id", stages.languages),
    ("near_duplicates", stages.near_duplicates),
    ("personal_data", stages.personal_data),
    ("mixture", stages.mixture),
    ("tokens", stages.tokens),
]

#: Learned language filters, SimHash and BPE are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
