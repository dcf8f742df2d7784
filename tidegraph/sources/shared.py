"""Written tables in the shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. A local session without one (tests) gets its own; a cluster must name one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def _own(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tidegraph/{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """df, written once as Parquet in the shared folder and read again with the same schema."""
    spark = df.sparkSession
    path = f"{_own(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Deletes all tables that this application has written; call it once no result that reads them is needed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
