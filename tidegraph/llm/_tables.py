"""Tables of the pipeline: inputs by name, and written tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegraph.sources.shared import materialise, shared_dir

__all__ = ["materialise", "shared_dir", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
