"""Registered queries over the test tables, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegraph.functions.scoring import Profile
from tidegraph.operators import trend
from tidegraph.sources import testdata as t

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def add(name: str, sql: str | None = None):
    """Registers a query; its SQL is a select (or further common tables and a select) over the model."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = f"with recursive {t.MODEL.strip()} {sql.strip()}"
        return f

    return put


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.trending(t.mentions(spark, sf_dir, None, t.AS_OF), t.AS_OF, Profile())


from tidegraph.plans import graph_queries, health_queries, resolve_queries, select_queries, trend_queries  # noqa: E402, F401, I001
from tidegraph.plans import ingest_queries  # noqa: E402, F401  (uses SQL of the others)
from tidegraph.plans import cleanup_queries  # noqa: E402, F401  (uses SQL of the others)
from tidegraph.plans import operations_queries  # noqa: E402, F401  (uses SQL of the others)
from tidegraph.plans import contract_queries  # noqa: E402, F401  (uses SQL of the others)
from tidegraph.plans import drop_queries  # noqa: E402, F401
from tidegraph.plans import log_queries  # noqa: E402, F401
