"""JSON files in and out: drop folders of documents, lines, and views with a header."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.functions.contracts import MOVER, MOVERS_META
from tidegraph.functions.schema import errors, row_errors
from tidegraph.sources.shared import materialise


def read_documents(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(file, x) of the readable JSON files of a folder, and (file) of the others."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    ok = F.try_parse_json("value").isNotNull()
    return raw.where(ok).select("file", F.from_json("value", schema).alias("x")), raw.where(~ok).select("file")


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def write_lines(rows: DataFrame, path: str, by: list[str] | None = None) -> None:
    w = rows.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).json(path)


def write_view(nodes: DataFrame, edges: DataFrame, path: str, **meta: str) -> None:
    """A graph view: nodes and edges as JSON lines, written in parallel, and a header with their numbers.

    The header is written last: a view without one is not complete.
    """
    spark = nodes.sparkSession
    write_lines(nodes, f"{path}/nodes")
    write_lines(edges, f"{path}/edges")
    sizes = [spark.read.text(f"{path}/{x}").count() for x in ("nodes", "edges")]
    head = spark.createDataFrame([(*map(str, meta.values()), *sizes)], ", ".join([*(f"{k} string" for k in meta), "nodes long", "edges long"]))
    write_lines(head.coalesce(1), f"{path}/meta")


def write_checked(rows: DataFrame, path: str, required: list[str]) -> None:
    """JSON lines, only if no row lacks a required field."""
    missing = [c for c in required if c not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    bad = rows.where(" or ".join(f"`{c}` is null" for c in required)) if required else rows.limit(0)
    if not bad.isEmpty():
        raise ValueError("rows lack required fields")
    write_lines(rows, path)


def write_valid(rows: DataFrame, path: str, rules: dict, shown: int = 5) -> DataFrame:
    """JSON lines, only if every row fits its schema; null columns are written as nulls. Gives the rows as checked.

    The rows are written to the shared folder first, so that what is checked is what is published;
    the errors of the first rows that fail are named.
    """
    kept = materialise(rows, "checked")
    bad = kept.withColumn("errors", row_errors(kept, rules)).where("size(errors) > 0").select(F.to_json(F.struct(*kept.columns)).alias("row"), "errors").limit(shown).collect()
    if bad:
        raise ValueError("rows do not fit their schema: " + "; ".join(f"{', '.join(r['errors'])} in {r['row']}" for r in bad))
    kept.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return kept


def write_movers(rows: DataFrame, path: str, meta: dict) -> None:
    """The movers view: rows and a head with their number, both only if they fit their contracts. The head is written last."""
    kept = write_valid(rows, f"{path}/rows", MOVER)
    head = kept.sparkSession.createDataFrame([(json.dumps(meta | {"rowCount": kept.count()}),)], "value string")
    wrong = head.select(errors(MOVERS_META, F.parse_json("value"))).first()[0]
    if wrong:
        raise ValueError(f"the head does not fit its schema: {', '.join(wrong)}")
    head.coalesce(1).write.mode("overwrite").text(f"{path}/meta")
