"""Alerts, suggestions, budgets, batch jobs, run logs, model comparison, epochs, and feed configuration."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegraph.operators import operations as ops
from tidegraph.operators import trend
from tidegraph.plans.health_queries import FEEDS, feeds
from tidegraph.plans.registry import add
from tidegraph.plans.resolve_queries import ANSWERS, answers
from tidegraph.plans.trend_queries import HISTORY_SQL, history
from tidegraph.sources import feeds as config
from tidegraph.sources import testdata as t
from tidegraph.sources.shared import materialise

NOW = "2024-02-02 12:00:00"

SILENT = """, dom as (select 'd' || o_custkey % 5 as domain, strftime(max(o_orderdate) filter (o_custkey % 5 <> 4), '%Y-%m-%d') as last_doc,
  case when o_custkey % 5 = 1 then 'never' else '2024-02-02' end as last_run from orders group by o_custkey % 5),
fd as (select 'd' || user_id % 5 as domain, 'f' || user_id % 35 as feed, user_id % 35 % 3 > 0 as enabled, strftime(max(ts), '%Y-%m-%d') as last from events group by user_id % 5, user_id % 35),
late as (select 'domain:' || domain || ':docs' as key, domain, date_diff('second', last_doc::timestamp, timestamp '2024-02-02 12:00:00') / 3600.0::double as age, last_doc as last from dom
  union all select 'domain:' || domain || ':trend', null, date_diff('second', try_cast(last_run as timestamp), timestamp '2024-02-02 12:00:00') / 3600.0::double, last_run from dom),
alert as (select key, age, last from late where age is null or age > 1000000
  union all select 'feed:' || domain || '/' || feed, date_diff('second', last::timestamp, timestamp '2024-02-02 12:00:00') / 3600.0::double, last from fd
  where enabled and date_diff('second', last::timestamp, timestamp '2024-02-02 12:00:00') / 3600.0::double > 72 and domain not in (select domain from late where domain is not null and (age is null or age > 1000000)))"""


def _alerts(spark, sf):
    o = t.table(spark, sf, "orders").withColumn("k", F.col("o_custkey") % 5)
    last = F.date_format(F.max(F.when(F.col("k") != 4, F.col("o_orderdate"))), "yyyy-MM-dd")
    domains = o.groupBy("k").agg(last.alias("last_doc")).select(F.concat(F.lit("d"), "k").alias("domain"), "last_doc", F.when(F.col("k") == 1, "never").otherwise("2024-02-02").alias("last_run"))
    e = t.table(spark, sf, "events").groupBy(F.col("user_id") % 5, F.col("user_id") % 35).agg(F.date_format(F.max("ts"), "yyyy-MM-dd").alias("last"))
    f = e.toDF("d", "f", "last").select(F.concat(F.lit("d"), "d").alias("domain"), F.concat(F.lit("f"), "f").alias("feed"), (F.col("f") % 3 > 0).alias("enabled"), "last")
    return ops.staleness(domains, f, NOW, 1_000_000, 3)


@add("a31_alerts", SILENT + " select key, round(age, 6) as age, last from alert")
def a31_alerts(spark, sf):
    return _alerts(spark, sf)


@add("x7_repage", SILENT + """, st as (select key, case when key like '%3%' then '2024-02-02 06:00:00' else '2024-01-31 00:00:00' end as paged_at from alert where key not like '%:trend')
select a.key, cast(paged_at is null or date_diff('second', paged_at::timestamp, timestamp '2024-02-02 12:00:00') >= 86400 as int) as due from alert a left join st using (key)""")
def x7_repage(spark, sf):
    a = _alerts(spark, sf)
    state = a.where("key not like '%:trend'").select("key", F.when(F.col("key").like("%3%"), "2024-02-02 06:00:00").otherwise("2024-01-31 00:00:00").alias("paged_at"))
    return ops.page(a, state, NOW, 24)[0].select("key", "due")


@add("f23_calibration", HISTORY_SQL + FEEDS + """, st as (select *, sum(cast(fetch_errors = 0 as int)) over (partition by feed_name order by run_date desc) as clean from feeds),
ms as (select 'error_streak' as m, feed_name as subject, count(*) filter (clean = 0)::double as v from st group by 2
  union all select 'orphan_edges', rel, count(*)::double from relations where kind <> 'hypothesis' group by 2
  union all select 'gated_share', run_date, avg(velocity_gated) from history group by 2
  union all select 'novelty_below', run_date, avg(cast(novelty < 0.1 as int)) from history group by 2
  union all select 'novelty_above', run_date, avg(cast(novelty > 0.8 as int)) from history group by 2
  union all select 'top_overlap', a.run_date, count(b.entity_id) / 10.0::double from ranked a left join ranked b on b.entity_id = a.entity_id and b.rank <= 10 and b.run_date = strftime(a.run_date::date - 7, '%Y-%m-%d') where a.rank <= 10 group by 2
  union all select 'source_yield_drop', source, 1 - count(*) filter (status = 'extracted')::double / count(*) from docs group by 2)
select subject, signal, severity, round(v, 6) as value, case severity when 'CRITICAL' then 0 when 'WARN' then 1 else 2 end as place from (
  select subject, v, case m when 'error_streak' then 'feed_error_streak' when 'orphan_edges' then 'orphan_edges' when 'gated_share' then 'velocity_gate_saturation' when 'novelty_below' then 'novelty_compressed_low'
    when 'novelty_above' then 'novelty_compressed_high' when 'source_yield_drop' then 'low_yield_source' else case when v < 0.1 then 'trending_churn_unstable' else 'trending_churn_stale' end end as signal,
  case m when 'error_streak' then case when v >= 7 then 'CRITICAL' when v >= 3 then 'WARN' end when 'orphan_edges' then case when v > 500 then 'CRITICAL' when v > 100 then 'WARN' when v > 0 then 'INFO' end
    when 'gated_share' then case when v > 0.8 then 'WARN' end when 'source_yield_drop' then case when v > 0.5 then 'INFO' end when 'top_overlap' then case when v < 0.1 then 'WARN' when v > 0.7 then 'INFO' end
    else case when v > 0.9 then 'WARN' end end as severity from ms) where severity is not null""")
def f23_calibration(spark, sf):
    w = Window.partitionBy("feed_name").orderBy(F.desc("run_date")).rowsBetween(Window.unboundedPreceding, 0)
    streak = feeds(spark, sf).withColumn("clean", F.sum((F.col("fetch_errors") == 0).cast("int")).over(w)).groupBy("feed_name").agg(F.count_if(F.col("clean") == 0).alias("v"))
    h = materialise(history(spark, sf), "history")
    per_run = h.groupBy("run_date").agg(F.avg("velocity_gated").alias("g"), F.avg((F.col("novelty") < 0.1).cast("int")).alias("b"), F.avg((F.col("novelty") > 0.8).cast("int")).alias("a"))
    top = trend.ranks(h).where("rank <= 10").select("run_date", "entity_id")
    later = F.date_format(F.date_add(F.col("run_date").cast("date"), 7), "yyyy-MM-dd")
    was = top.select(later.alias("run_date"), "entity_id", F.lit(1).alias("both"))
    overlap = top.join(was, ["run_date", "entity_id"], "left").groupBy("run_date").agg((F.count("both") / 10.0).alias("v"))
    row = lambda d, m, s, v: d.select(F.lit(m).alias("measure"), F.col(s).alias("subject"), v.cast("double").alias("value"))
    m = row(streak, "error_streak", "feed_name", F.col("v"))
    edges = t.relations(spark, sf).where("kind <> 'hypothesis'").groupBy("rel").agg(F.count("*").alias("v"))
    m = m.union(row(edges, "orphan_edges", "rel", F.col("v")))
    for name, c in (("gated_share", "g"), ("novelty_below", "b"), ("novelty_above", "a")):
        m = m.union(row(per_run, name, "run_date", F.col(c)))
    drop = t.documents(spark, sf).groupBy("source").agg((1 - F.count_if(F.col("status") == "extracted") / F.count("*")).alias("v"))
    m = m.union(row(overlap, "top_overlap", "run_date", F.col("v"))).union(row(drop, "source_yield_drop", "source", F.col("v")))
    return ops.suggestions(m).withColumn("value", F.round("value", 6))


@add("d11_budgets", "select n_name as domain, coalesce(b, 20) as budget, coalesce(s, case when b is not null then b + 5 else 25 end) as stretch from (select n_name, case when n_nationkey % 3 > 0 then n_nationkey + 10 end as b, case when n_nationkey % 2 = 0 then n_nationkey + 40 end as s from nation)")
def d11(spark, sf):
    k = F.col("n_nationkey")
    n = t.table(spark, sf, "nation").select(F.col("n_name").alias("domain"), F.when(k % 3 > 0, k + 10).alias("budget"), F.when(k % 2 == 0, k + 40).alias("stretch"))
    return ops.budgets(n)


BATCH = """, cand as (select 'd' || o_custkey % 3 as domain, strftime(o_orderdate, '%Y-%m-%d') as run_date, 'doc:' || o_orderkey as doc_id from orders),
busy as (select distinct domain, run_date from cand where domain = 'd1' and substr(run_date, 10) = '1'),
sub as (select domain || '_' || run_date as job_id, domain, run_date, doc_id from cand where (domain, run_date) not in (select (domain, run_date) from busy) and doc_id not in (select doc_id from docs where status = 'extracted'))"""


def _submitted(spark, sf):
    o = t.table(spark, sf, "orders")
    cand = o.select(F.concat(F.lit("d"), F.col("o_custkey") % 3).alias("domain"), t.day("o_orderdate").alias("run_date"), F.concat(F.lit("doc:"), "o_orderkey").alias("doc_id"))
    jobs = cand.where("domain = 'd1' and substr(run_date, 10) = '1'").select("domain", "run_date").distinct().withColumn("status", F.lit("pending"))
    return ops.submit(jobs, cand, t.documents(spark, sf).where("status = 'extracted'"), NOW)


@add("m8_batch_submit", BATCH + " select job_id, domain, run_date, '2024-02-02 12:00:00' as submitted_at, 'pending' as status, count(*) as docs from sub group by 1, 2, 3")
def m8_submit(spark, sf):
    return _submitted(spark, sf)[0]


@add("m8_batch_collect", BATCH + """, res as (select job_id, doc_id, case when cast(substr(doc_id, 5) as bigint) % 4 = 0 then 'errored' else 'succeeded' end as type from sub where domain <> 'd2' and cast(substr(doc_id, 5) as bigint) % 7 > 0),
ended as (select distinct job_id from res)
select s.job_id, s.doc_id, case when r.type = 'succeeded' then 'succeeded' else 'fallback' end as outcome, case when r.type = 'succeeded' then 'answer to ' || s.doc_id end as answer from sub s left join res r using (job_id, doc_id) where s.job_id in (select job_id from ended)""")
def m8_collect(spark, sf):
    jobs, docs = _submitted(spark, sf)
    k = F.substring_index("doc_id", ":", -1).cast("long")
    res = docs.where(~F.col("job_id").startswith("d2") & (k % 7 > 0))
    res = res.select("job_id", "doc_id", F.when(k % 4 == 0, "errored").otherwise("succeeded").alias("type"), F.concat(F.lit("answer to "), "doc_id").alias("answer"))
    return ops.collect(jobs, docs, res, NOW)[1]


@add("a27_runs", FEEDS + """, lg as (select run_date, feed_name, case when docs_fetched % 4 > 0 then docs_fetched end as bundled, case when fetch_errors % 3 > 0 then fetch_errors end as extracted, case when docs_fetched % 2 > 0 then docs_fetched else 0 end as e, docs_fetched * 10 as n from feeds)
select run_date, feed_name as domain, case when n % 30 > 0 then 'ok' else 'unknown' end as status, n / 4.0::double as duration, n // 10 as new_docs, coalesce(bundled, 0) as bundled, case when e > 0 then e else n end as entities, case when e > 0 then e * 2 else n end as relations,
  n as nodes, case when n % 20 > 0 then n * 2 end as edges, case when coalesce(bundled, 0) <> 0 or coalesce(extracted, 0) <> 0 then greatest(0, coalesce(bundled, 0) - coalesce(extracted, 0)) end as backlog from lg""")
def a27(spark, sf):
    """Run logs as JSON, read again with the fields that reports use."""
    s, n = F.struct, F.col("docs_fetched") * 10
    e = F.when(F.col("docs_fetched") % 2 > 0, F.col("docs_fetched")).otherwise(0)
    log = s(
        F.col("run_date").alias("runDate"), F.col("feed_name").alias("domain"), F.when(n % 30 > 0, "ok").alias("status"), (n / 4).alias("durationSec"),
        s(
            s(F.col("docs_fetched").alias("newDocsFound")).alias("ingest"), s(F.when(F.col("docs_fetched") % 4 > 0, F.col("docs_fetched")).alias("docsBundled")).alias("docpack"),
            s(F.when(F.col("fetch_errors") % 3 > 0, F.col("fetch_errors")).alias("docsExtracted"), e.alias("entitiesFound"), (e * 2).alias("relationsFound")).alias("extract"),
            s(n.alias("entitiesNew"), n.alias("relations")).alias("import"), s(n.alias("totalNodes"), F.when(n % 20 > 0, n * 2).alias("totalEdges")).alias("export"),
        ).alias("stages"),
    )
    return ops.runs(feeds(spark, sf).select(F.from_json(F.to_json(log), ops.LOG).alias("x")))


@add("e13_models", ANSWERS + """, md as (select an.*, 'm' || cast(split_part(doc_id, ':', 2) as bigint) % 3 as model from an),
bad as (select doc_id, bool_or(kind = 'guess' or confidence > 1 or (kind = 'asserted' and evidence = 0)) as bad from ar group by 1)
select model, count(*) as answers, round(avg(cast(not broken as int)), 6) as parse_rate, round(count(*) filter (not broken and not no_id and not bad)::double / count(*), 6) as schema_rate from md join bad using (doc_id) group by 1""")
def e13(spark, sf):
    k = F.substring_index("doc_id", ":", -1).cast("long")
    return ops.compare_models(answers(spark, sf).withColumn("model", F.concat(F.lit("m"), k % 3)))


EPOCHS = HISTORY_SQL + """, he as (select *, case when run_date < '2024-01-15' then 1 else 2 end as epoch, round(velocity / 2, 6) as bridge_score, count(*) over (partition by run_date) as corpus_entity_count from history),
pr as (select distinct a.run_date, a.epoch, (select max(run_date) from he b where b.epoch = a.epoch and b.run_date::date <= a.run_date::date - 7) as prior from he a)"""


def _epochs(spark, sf):
    h = history(spark, sf)
    return ops.with_snapshot(h, F.when(F.col("run_date") < "2024-01-15", 1).otherwise(2), "1", 0.05, 3).withColumn("bridge_score", F.round(F.col("velocity") / 2, 6))


@add("r5_history_snapshot", EPOCHS + " select entity_id, run_date, trend_score, 0.05::double as novelty_decay, 3 as min_mentions, corpus_entity_count, epoch, '1' as methodology_version from he")
def r5_snapshot(spark, sf):
    return _epochs(spark, sf).select("entity_id", "run_date", "trend_score", "novelty_decay", "min_mentions", "corpus_entity_count", "epoch", "methodology_version")


@add("j14_prior_runs", EPOCHS + " select run_date, epoch, prior from pr")
def j14_epochs(spark, sf):
    return ops.prior_runs(_epochs(spark, sf))


@add("w5_changes", EPOCHS + """ select a.entity_id, a.run_date, a.epoch, pr.prior, cast(b.entity_id is null as int) as is_new, round(a.trend_score - b.trend_score, 6) as score_delta, round(a.bridge_score - b.bridge_score, 6) as bridge_delta,
  cast(coalesce(a.velocity > 1 and b.velocity > 1, false) as int) as sustained from he a join pr on pr.run_date = a.run_date and pr.epoch = a.epoch left join he b on b.entity_id = a.entity_id and b.epoch = a.epoch and b.run_date = pr.prior""")
def w5_changes(spark, sf):
    return ops.changes(materialise(_epochs(spark, sf), "history"))


@add("s11_feed_config", """, c as (select *, case when s_suppkey % 4 > 0 then s_suppkey % 3 > 0 end as en from supplier)
select s_name as name, 'http://' || s_suppkey as url, case when s_suppkey % 2 = 0 then 'api' else 'rss' end as type, true as enabled, case when s_suppkey % 5 = 0 then cast(s_suppkey as int) else 0 end as limit, 1 as tier, 'primary' as signal,
  case when s_suppkey % 3 = 1 then 'color=' || s_nationkey else '' end as extra from c where coalesce(en, true)""")
def s11(spark, sf):
    k = F.col("s_suppkey")
    line = F.to_json(F.struct(
        F.col("s_name").alias("name"), F.concat(F.lit("http://"), k).alias("url"), F.when(k % 2 == 0, "api").alias("type"), F.when(k % 4 > 0, k % 3 > 0).alias("enabled"),
        F.when(k % 5 == 0, k).alias("limit"), F.when(k % 3 == 1, F.col("s_nationkey")).alias("color"),
    ))
    f = config.feed_config(t.table(spark, sf, "supplier").select(line.alias("value")))
    text = F.array_join(F.transform(F.map_entries("extra"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return f.withColumn("extra", text)
