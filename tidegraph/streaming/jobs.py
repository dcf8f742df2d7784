"""Incremental forms over Structured Streaming; the batch operators stay the authority."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json(spark: SparkSession, path: str, schema: str, per_trigger: int = 100) -> DataFrame:
    """A drop directory of JSON lines as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).json(path)


def rolling_mentions(stream: DataFrame, days: int = 7, late: str = "2 days") -> DataFrame:
    """Sliding windows of mentions (entity_id, ts); half-open, so one day less than the batch windows."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", f"{days} days", "1 day"), "entity_id").agg(F.count("*").alias("mentions"))


def first_last(stream: DataFrame) -> DataFrame:
    """First and last time that each entity was seen."""
    return stream.groupBy("entity_id").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


def dedup(stream: DataFrame, key: str = "url", late: str = "2 days") -> DataFrame:
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def quarantine(stream: DataFrame, now, days: int = 2) -> DataFrame:
    """Rows dated more than `days` ahead are left out."""
    return stream.where(F.col("ts") <= F.timestamp_add("DAY", F.lit(days), now))


def error_sessions(stream: DataFrame, gap: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Sessions of errors per feed."""
    e = stream.where("event_type = 'error'").withWatermark("ts", late)
    return e.groupBy(F.session_window("ts", gap), "source").agg(F.count("*").alias("errors"))


def _benched(days, key, frames, state):
    """Rows of one document that enter the bench; the state is when its last entry expires."""
    if state.hasTimedOut:
        state.remove()
        return
    until = state.get[0] if state.exists else None
    kept = []
    for at in sorted(x for f in frames for x in f["scored_at"]):
        if until is None or at.timestamp() >= until:
            until = at.timestamp() + days * 86400
            kept.append(at)
    state.update((until,))
    state.setTimeoutTimestamp(int(until * 1000))
    if kept:
        yield pd.DataFrame({"doc_id": [key[0]] * len(kept), "scored_at": kept})


def bench(stream: DataFrame, days: int = 5, late: str = "2 days") -> DataFrame:
    """Benched documents (doc_id, scored_at, expires_at); one already on the bench is ignored until it has expired.

    Exact whatever the batches, for rows in order within `late`: the built-in deduplication keeps
    keys until the end of a later batch. The state of a document goes after its expiry, so it
    never holds more than the bench and what may still come late. Rows without id or time are left out.
    """
    rows = stream.where("doc_id is not null and scored_at is not null").withWatermark("scored_at", late)
    once = rows.groupBy("doc_id").applyInPandasWithState(
        lambda *x: _benched(days, *x), "doc_id string, scored_at timestamp", "until double", "append", "EventTimeTimeout"
    )
    return once.withColumn("expires_at", F.timestamp_add("DAY", F.lit(days), F.col("scored_at")))


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Everything there is, then stop. A complete result replaces the last one; in append mode each
    batch has its own folder (column `batch`), so a batch that is run again replaces itself."""

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/batch={n}")

    q = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
