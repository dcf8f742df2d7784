"""Changes of tables as transforms: old and new frames in, the new state out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replace(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Insert or replace: rows of `new` win; columns it lacks become null."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def insert_ignore(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    return old.unionByName(new.join(old.select(*key), key, "left_anti"), allowMissingColumns=True)


def upsert_entities(old: DataFrame, new: DataFrame) -> DataFrame:
    """New values win where they are not null; the first day stays, the last only rises."""
    n = new.select(*(F.col(c).alias(f"n_{c}" if c != "entity_id" else c) for c in new.columns))
    j = old.join(n, "entity_id", "full")
    return j.select(
        "entity_id", F.coalesce("n_name", "name").alias("name"), F.coalesce("n_type", "type").alias("type"),
        F.coalesce("first_seen", "n_first_seen").alias("first_seen"), F.greatest("last_seen", "n_last_seen").alias("last_seen"),
    )


def delete(rows: DataFrame, where) -> DataFrame:
    """Rows for which the condition is not true (null keeps the row)."""
    return rows.where(~F.coalesce(where, F.lit(False)))


def next_status(ok, shelved) -> object:
    return F.when(shelved, "shelved").when(ok, "extracted").otherwise("error")
