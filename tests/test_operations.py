"""Alerts, suggestions, batches, run logs, feed configuration and streams on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from tidegraph.operators import operations as ops
from tidegraph.sources import feeds
from tidegraph.streaming import jobs

NOW = "2024-02-02 12:00:00"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_staleness_and_paging(spark):
    domains = spark.createDataFrame([("a", "2024-01-01", "2024-02-02"), ("b", "2024-02-02", None), ("c", "2024-02-02", "2024-02-02")], "domain string, last_doc string, last_run string")
    f = spark.createDataFrame([("a", "x", True, "2024-01-01"), ("c", "y", True, "2024-01-01"), ("c", "z", False, "2024-01-01"), ("c", "w", True, None), ("c", "v", True, "2024-02-01")], "domain string, feed string, enabled boolean, last string")
    alerts = ops.staleness(domains, f, NOW, 48, 7)
    assert [r[0] for r in rows(alerts)] == ["domain:a:docs", "domain:b:trend", "feed:c/y"]
    state = spark.createDataFrame([("domain:a:docs", "2024-02-02 00:00:00"), ("feed:c/y", "2024-02-01 12:00:00"), ("gone", NOW)], "key string, paged_at string")
    paged, after = ops.page(alerts, state, NOW, 24)
    assert {r["key"]: r["due"] for r in paged.collect()} == {"domain:a:docs": 0, "domain:b:trend": 1, "feed:c/y": 1}
    assert {r["key"]: r["paged_at"] for r in after.collect()} == {"domain:a:docs": "2024-02-02 00:00:00", "domain:b:trend": NOW, "feed:c/y": NOW}
    assert ops.staleness(domains.limit(0), f.limit(0), NOW, 48, 7).count() == 0


def test_suggestions(spark):
    m = [("orphan_edges", "day", 500.0), ("orphan_edges", "day", 501.0), ("error_streak", "f", 3.0), ("error_streak", "g", 2.0), ("top_overlap", "r", 0.05), ("top_overlap", "s", 0.5), ("top_overlap", "t", None), ("other", "u", 9.0)]
    got = rows(ops.suggestions(spark.createDataFrame(m, "measure string, subject string, value double")))
    assert got == [("day", "orphan_edges", "CRITICAL", 501.0, 0), ("day", "orphan_edges", "WARN", 500.0, 1), ("f", "feed_error_streak", "WARN", 3.0, 1), ("r", "trending_churn_unstable", "WARN", 0.05, 1)]


def test_budgets(spark):
    p = spark.createDataFrame([("a", None, None), ("b", 7, None), ("c", None, 9), ("d", 7, 8)], "domain string, budget int, stretch int")
    assert rows(ops.budgets(p)) == [("a", 20, 25), ("b", 7, 12), ("c", 20, 9), ("d", 7, 8)]


def test_batches(spark):
    cand = spark.createDataFrame([("a", "d1", "x"), ("a", "d1", "x"), ("a", "d1", "y"), ("a", "d2", "z"), ("b", "d1", "w")], "domain string, run_date string, doc_id string")
    jobs_ = spark.createDataFrame([("b", "d1", "pending"), ("a", "d1", "complete")], "domain string, run_date string, status string")
    done = spark.createDataFrame([("y",)], "doc_id string")
    new, docs = ops.submit(jobs_, cand, done, NOW)
    assert rows(new.select("job_id", "docs")) == [("a_d1", 1), ("a_d2", 1)]
    res = spark.createDataFrame([("a_d1", "x", "errored", None), ("a_d1", "x", "succeeded", "late"), ("a_d1", "x", "succeeded", "ok")], "job_id string, doc_id string, type string, answer string")
    after, out = ops.collect(new, docs, res, NOW)
    assert rows(out) == [("a_d1", "x", "succeeded", "late")]
    assert rows(after.select("job_id", "status", "completed_at")) == [("a_d1", "complete", NOW), ("a_d2", "pending", None)]
    assert rows(ops.collect(new, docs, res.where("type = 'errored'"), NOW)[1]) == [("a_d1", "x", "fallback", None)]
    assert ops.collect(after, docs, res, NOW)[1].count() == 0


def test_run_logs(spark, tmp_path):
    log = {"runDate": "2024-01-02", "domain": "a", "stages": {"docpack": {"docsBundled": 5}, "extract": {"docsExtracted": 7, "entitiesFound": 0}, "import": {"entitiesNew": 3}}, "more": 1}
    (tmp_path / "run_2.json").write_text(json.dumps(log))
    (tmp_path / "run_1.json").write_text(json.dumps({"runDate": "2024-01-01", "status": "ok"}))
    (tmp_path / "run_0.json").write_text("{")
    logs = ops.read_logs(spark, str(tmp_path))
    got = {r["run_date"]: r.asDict() for r in ops.runs(logs).collect()}
    assert got["2024-01-02"]["entities"] == 3 and got["2024-01-02"]["backlog"] == 0 and got["2024-01-02"]["status"] == "unknown"
    assert got["2024-01-01"]["backlog"] is None and got["2024-01-01"]["new_docs"] == 0 and got["2024-01-01"]["relations"] is None
    s = ops.status(logs, F.lit(11), F.lit(12)).collect()
    assert len(s) == 1 and s[0]["run_date"] == "2024-01-02" and (s[0]["nodes"], s[0]["edges"]) == (11, 12)
    assert ops.read_logs(spark, str(tmp_path), 1).count() == 1 and ops.status(logs.limit(0), F.lit(1), F.lit(1)).count() == 0


def test_epochs_never_meet(spark):
    h = [("e", "2024-01-01", 1, 2.0, 0.5, 1.0), ("e", "2024-01-08", 2, 3.0, 0.7, 2.0), ("e", "2024-01-14", 2, 3.0, 0.8, 2.0), ("e", "2024-01-15", 2, 2.0, 0.9, 4.0), ("n", "2024-01-15", 2, 2.0, 0.1, 0.0)]
    d = spark.createDataFrame(h, "entity_id string, run_date string, epoch int, velocity double, trend_score double, bridge_score double")
    assert rows(ops.prior_runs(d)) == [("2024-01-01", 1, None), ("2024-01-08", 2, None), ("2024-01-14", 2, None), ("2024-01-15", 2, "2024-01-08")]
    got = {(r["entity_id"], r["run_date"]): r for r in ops.changes(d).collect()}
    assert len(got) == 5 and got["e", "2024-01-08"]["is_new"] == 1 and got["e", "2024-01-08"]["score_delta"] is None
    last = got["e", "2024-01-15"]
    assert (last["score_delta"], last["bridge_delta"], last["sustained"], last["is_new"]) == (0.2, 2.0, 1, 0) and got["n", "2024-01-15"]["is_new"] == 1


def test_feed_configuration(spark):
    lines = ['{"name": "a", "color": "red", "limit": 3}', '{"name": "b", "enabled": false}', "{", None, '{"url": "x"}', '{"name": "c", "type": "api"}']
    d = spark.createDataFrame([(x,) for x in lines], "value string")
    f = {r["name"]: r.asDict() for r in feeds.feed_config(d, disabled=True).collect()}
    assert set(f) == {"a", "b", "c"} and f["a"]["extra"] == {"color": "red"} and (f["a"]["limit"], f["a"]["type"], f["a"]["signal"]) == (3, "rss", "primary")
    assert {r["name"] for r in feeds.feed_config(d).collect()} == {"a", "c"}


def test_dispatch(spark, monkeypatch):
    monkeypatch.setattr(feeds, "READERS", {})
    feeds.reader("rss")(lambda f: f.select(F.concat("name", F.lit("-rss")).alias("doc_id")))
    feeds.reader("api")(lambda f: f.select(F.concat("name", F.lit("-api")).alias("doc_id")))
    d = spark.createDataFrame([("a", "rss"), ("b", "api"), ("c", "rss")], "name string, type string")
    assert rows(feeds.dispatch(d)) == [("a-rss",), ("b-api",), ("c-rss",)]
    with pytest.raises(ValueError, match="gopher"):
        feeds.dispatch(d.union(spark.createDataFrame([("d", "gopher")], d.schema)))


def _stream(spark, tmp_path, lines, schema):
    """Each list of lines arrives in a batch of its own, in order."""
    import os

    folder = tmp_path / "in"
    folder.mkdir()
    for i, batch in enumerate(lines):
        (folder / f"{i}.json").write_text("\n".join(json.dumps(x) for x in batch))
        os.utime(folder / f"{i}.json", (1_700_000_000 + i * 10,) * 2)
    return jobs.read_json(spark, str(folder), schema, 1)


def _out(spark, tmp_path, df, mode="append"):
    jobs.run_available(df, str(tmp_path / "out"), str(tmp_path / "state"), mode)
    return spark.read.parquet(str(tmp_path / "out"))


def test_stream_rolling_mentions(spark, tmp_path):
    lines = [[{"entity_id": "a", "ts": "2024-01-10 01:00:00"}, {"entity_id": "a", "ts": "2024-01-08 01:00:00"}], [{"entity_id": "a", "ts": "2024-01-09 01:00:00"}, {"entity_id": "b", "ts": "2024-01-10 02:00:00"}]]
    s = _stream(spark, tmp_path, lines, "entity_id string, ts timestamp")
    got = _out(spark, tmp_path, jobs.rolling_mentions(s, 7), "complete")
    at = {(r["entity_id"], str(r["window"]["start"])[:10]): r["mentions"] for r in got.collect()}
    assert at["a", "2024-01-04"] == 3 and at["a", "2024-01-03"] == 2 and at["b", "2024-01-10"] == 1 and at["a", "2024-01-09"] == 2  # the late row counts


def test_stream_quarantine(spark, tmp_path):
    s = _stream(spark, tmp_path, [[{"ts": "2024-01-03 00:00:00"}, {"ts": "2024-01-03 00:00:01"}, {"ts": None}]], "ts timestamp")
    got = _out(spark, tmp_path, jobs.quarantine(s, F.lit("2024-01-01").cast("timestamp")))
    assert [str(r["ts"]) for r in got.collect()] == ["2024-01-03 00:00:00"]


def test_stream_error_sessions(spark, tmp_path):
    e = lambda ts, kind="error": {"source": "f", "event_type": kind, "ts": ts}
    lines = [[e("2024-01-01 00:00:00"), e("2024-01-01 00:30:00"), e("2024-01-01 00:40:00", "view"), e("2024-01-01 02:00:00")], [e("2024-01-03 00:00:00")]]
    got = _out(spark, tmp_path, jobs.error_sessions(_stream(spark, tmp_path, lines, "source string, event_type string, ts timestamp")))
    assert sorted(r["errors"] for r in got.collect()) == [1, 2]


def test_stream_bench(spark, tmp_path):
    b = lambda d, ts: {"doc_id": d, "scored_at": ts}
    lines = [[b("x", "2024-01-01 00:00:00")], [b("x", "2024-01-03 00:00:00"), b("y", "2024-01-03 00:00:00")], [b("z", "2024-01-20 00:00:00")], [b("x", "2024-01-20 00:00:00")]]
    got = _out(spark, tmp_path, jobs.bench(_stream(spark, tmp_path, lines, "doc_id string, scored_at timestamp")))
    assert rows(got.select("doc_id", F.col("expires_at").cast("string"))) == [("x", "2024-01-06 00:00:00"), ("x", "2024-01-25 00:00:00"), ("y", "2024-01-08 00:00:00"), ("z", "2024-01-25 00:00:00")]
