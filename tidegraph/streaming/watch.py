"""Silence of sources as a stream: pages by timers, again and again, until the source returns or is given up."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

HOUR = 3_600_000
OUT = "source string, event string, at timestamp, last timestamp, pages int"


def _ms(at: datetime) -> int:
    return int(at.replace(tzinfo=at.tzinfo or timezone.utc).timestamp() * 1000)


def _at(ms: int) -> datetime:
    return datetime.fromtimestamp(ms / 1000, tz=timezone.utc)


class _Silence(StatefulProcessor):
    """The state of a source: when it was last heard of (ms), and how often it has been paged since."""

    def __init__(self, silent: int, again: int, given_up: int, event_time: bool):
        self.silent, self.again, self.given_up, self.event_time = silent, again, given_up, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.heard = handle.getValueState("heard", "last long, pages int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        newest = max(_ms(r["ts"]) for r in rows)
        last, pages = self.heard.get() if self.heard.exists() else (None, 0)
        if last is not None and newest <= last:  # late rows tell nothing new
            return
        if pages:
            yield Row(source=key[0], event="returned", at=_at(newest), last=_at(last), pages=pages)
        self._wait(newest + self.silent if self.event_time else timerValues.getCurrentProcessingTimeInMs() + self.silent)
        self.heard.update((newest, 0))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        due = expiredTimerInfo.getExpiryTimeInMs()
        last, pages = self.heard.get()
        pages += 1
        if pages * self.again + self.silent > self.given_up:
            yield Row(source=key[0], event="given_up", at=_at(due), last=_at(last), pages=pages - 1)
            self.heard.clear()
            return
        yield Row(source=key[0], event="paged", at=_at(due), last=_at(last), pages=pages)
        self.heard.update((last, pages))
        self.handle.registerTimer(due + self.again)

    def _wait(self, until: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(until)

    def close(self) -> None:
        pass


def silence(stream: DataFrame, silent_hours: float = 48, again_hours: float = 24, given_up_hours: float = 24 * 30, late: str = "2 days", clock: str = "event") -> DataFrame:
    """(source, event, at, last, pages) of a stream (source, ts): paged, returned, given_up.

    A source without a row for silent_hours is paged, and again every again_hours; its next row
    is its return. given_up_hours after its last row nothing more is paged, and its state goes: what the
    stream holds is two numbers and one timer a source that is alive or was lately. Sources that were never
    heard of are not paged. Rows without source or time count for nothing, late rows (up to
    `late`) only if they are newer than what is known.

    clock: `event` measures by the watermark, so the same rows give the same pages whenever they are
    read; `processing` by the wall clock from the batch that a row came in, so silence is told
    while no source says anything. The session needs the RocksDB state store (see `use_rocksdb`).
    """
    event = clock == "event"
    if not event and clock != "processing":
        raise ValueError(f"clock is event or processing, not {clock}")
    rows = stream.where("source is not null and ts is not null").select("source", "ts")
    rows = rows.withWatermark("ts", late) if event else rows
    own = _Silence(int(silent_hours * HOUR), int(again_hours * HOUR), int(given_up_hours * HOUR), event)
    return rows.groupBy("source").transformWithState(statefulProcessor=own, outputStructType=OUT, outputMode="Append", timeMode="EventTime" if event else "ProcessingTime")


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that timers need; its changes are kept as a log, which recovers quickly."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def open_pages(events: DataFrame) -> DataFrame:
    """(source, since, pages) of the sources whose latest event is a page."""
    latest = events.groupBy("source").agg(F.max(F.struct("at", "event", "last", "pages")).alias("m"))
    return latest.where("m.event = 'paged'").select("source", F.col("m.last").alias("since"), "m.pages")
