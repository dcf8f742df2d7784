"""Silence as a stream: late rows, pages again and again, a return, and sources that are given up."""

import json
import time

from tidegraph.streaming import jobs, watch


def step(spark, tmp_path, n, rows, **settings):
    """One more file, read to the end; all events so far."""
    folder, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    folder.mkdir(exist_ok=True)
    (folder / f"{n:03}.json").write_text("\n".join(json.dumps({"source": s, "ts": t}) for s, t in rows))
    stream = jobs.read_json(spark, str(folder), "source string, ts timestamp", 1)
    q = watch.silence(stream, **settings).writeStream.format("parquet").option("checkpointLocation", mark).trigger(availableNow=True).start(out)
    assert q.awaitTermination(120)
    seen = spark.read.schema(watch.OUT).parquet(out)
    return seen, sorted((r["source"], r["event"], f"{r['at']:%d %H}", f"{r['last']:%d %H}", r["pages"]) for r in seen.collect())


def test_pages_by_event_time(spark, tmp_path):
    watch.use_rocksdb(spark)
    try:
        settings = {"silent_hours": 24, "again_hours": 12, "given_up_hours": 72, "late": "1 hour"}
        day = lambda d, h=0: f"2024-01-{d:02}T{h:02}:00:00Z"
        assert step(spark, tmp_path, 1, [("a", day(1)), ("b", day(1)), ("b", day(1, 5)), (None, day(1)), ("c", None)], **settings)[1] == []
        _, got = step(spark, tmp_path, 2, [("b", day(2, 14)), ("b", day(1, 2))], **settings)  # a is silent since the 1st; the older row is too late
        assert got == [("a", "paged", "02 00", "01 00", 1), ("a", "paged", "02 12", "01 00", 2)] or got == [("a", "paged", "02 00", "01 00", 1)]
        _, got = step(spark, tmp_path, 3, [("b", day(3, 1))], **settings)
        assert ("a", "paged", "02 12", "01 00", 2) in got and not [x for x in got if x[0] == "b"]
        seen, got = step(spark, tmp_path, 4, [("a", day(3, 6)), ("b", day(3, 7))], **settings)
        back = [x for x in got if x[1] == "returned"]
        assert len(back) == 1 and back[0][:4] == ("a", "returned", "03 06", "01 00")
        assert watch.open_pages(seen).count() == 0
        for n, d in enumerate((4, 5, 6, 7, 8, 9), 5):  # b goes on alone
            seen, got = step(spark, tmp_path, n, [("b", day(d, h)) for h in (0, 12)], **settings)
        mine = [x for x in got if x[0] == "a" and x[3] == "03 06"]
        assert [x[1] for x in mine if x[1] != "returned"].count("given_up") == 1 and sorted(x[4] for x in mine if x[1] == "paged") == [1, 2, 3, 4]
        assert not [x for x in got if x[0] == "b"] and watch.open_pages(seen).count() == 0
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        spark.conf.unset("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled")


def test_pages_by_the_wall_clock(spark, tmp_path):
    watch.use_rocksdb(spark)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.json").write_text(json.dumps({"source": "a", "ts": "2024-01-01T00:00:00Z"}))
    stream = jobs.read_json(spark, str(folder), "source string, ts timestamp")
    q = watch.silence(stream, silent_hours=2 / 3600, again_hours=1, given_up_hours=99, clock="processing").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "mark")).trigger(processingTime="1 second").start(str(tmp_path / "out"))
    try:
        until, got = time.time() + 60, []
        while not got and time.time() < until:  # no further rows: the timer alone tells
            time.sleep(1)
            got = spark.read.schema(watch.OUT).parquet(str(tmp_path / "out")).collect() if (tmp_path / "out").exists() else []
        assert [(r["source"], r["event"], r["pages"]) for r in got] == [("a", "paged", 1)]
    finally:
        q.stop()
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        spark.conf.unset("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled")
