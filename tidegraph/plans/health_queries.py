"""Reports: counts, rates, freshness, streaks, costs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegraph.operators import trend
from tidegraph.plans.registry import add
from tidegraph.sources import testdata as t

FEEDS = ", feeds as (select strftime(ts, '%Y-%m-%d') as run_date, 'feed' || user_id % 7 as feed_name, count(*) filter (event_type <> 'error') as docs_fetched, count(*) filter (event_type = 'error') as fetch_errors, round(sum(value), 2) as total from events group by 1, 2)"


def feeds(spark, sf):
    e = t.table(spark, sf, "events")
    return e.groupBy(t.day("ts").alias("run_date"), F.concat(F.lit("feed"), F.col("user_id") % 7).alias("feed_name")).agg(
        F.count_if(F.col("event_type") != "error").alias("docs_fetched"), F.count_if(F.col("event_type") == "error").alias("fetch_errors"), F.round(F.sum("value"), 2).alias("total")
    )


@add("s10_feed_stats", FEEDS + " select run_date, feed_name, docs_fetched, fetch_errors from feeds")
def s10(spark, sf):
    return feeds(spark, sf).select("run_date", "feed_name", "docs_fetched", "fetch_errors")


@add("a6_daily_ingestion", "select published_at as day, count(*) as n from docs group by 1 order by 1 desc limit 14")
def a6(spark, sf):
    return t.documents(spark, sf).groupBy(F.col("published_at").alias("day")).agg(F.count("*").alias("n")).orderBy(F.desc("day")).limit(14)


@add("a7_coverage", "select source, count(*) as docs, count(*) filter (status = 'extracted') as extracted, round(count(*) filter (status = 'extracted')::double / count(*), 6) as coverage, count(*) filter (status = 'cleaned') as backlog from docs group by 1")
def a7(spark, sf):
    done = F.count_if(F.col("status") == "extracted")
    return t.documents(spark, sf).groupBy("source").agg(F.count("*").alias("docs"), done.alias("extracted"), F.round(done / F.count("*"), 6).alias("coverage"), F.count_if(F.col("status") == "cleaned").alias("backlog"))


@add("a11_freshness", "select source, count(*) as n, max(published_at) as latest, min(published_at) as earliest, case when date_diff('day', cast(max(published_at) as date), date '2001-08-10') <= 14 then 'fresh' when date_diff('day', cast(max(published_at) as date), date '2001-08-10') <= 30 then 'aging' else 'stale' end as status from docs group by 1")
def a11(spark, sf):
    age = F.datediff(F.lit("2001-08-10").cast("date"), F.max("published_at").cast("date"))
    return t.documents(spark, sf).groupBy("source").agg(F.count("*").alias("n"), F.max("published_at").alias("latest"), F.min("published_at").alias("earliest"), F.when(age <= 14, "fresh").when(age <= 30, "aging").otherwise("stale").alias("status"))


@add("a13_rates_by_type", "select event_type, count(*) as n, round(avg(value), 4) as mean, min(value) as low, max(value) as high, round(count(*) filter (value > 20)::double / count(*), 6) as pass_rate from events group by 1")
def a13(spark, sf):
    v = F.col("value")
    return t.table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg(v), 4).alias("mean"), F.min(v).alias("low"), F.max(v).alias("high"), F.round(F.count_if(v > 20) / F.count("*"), 6).alias("pass_rate"))


PRICES = (("error", 0.5), ("click", 1.25), ("view", 0.75))


@add("a14_token_cost", "select strftime(ts, '%Y-%m-%d') as day, event_type as model, count(*) as calls, sum(event_id % 1000)::bigint as tokens, round(sum(event_id % 1000 * case event_type when 'error' then 0.5::double when 'click' then 1.25::double when 'view' then 0.75::double end), 4) as cost from events group by 1, 2")
def a14(spark, sf):
    """Unknown models have no price, so their cost is null."""
    price = spark.createDataFrame(PRICES, "event_type string, price double")
    e = t.table(spark, sf, "events").join(F.broadcast(price), "event_type", "left")
    tokens = F.col("event_id") % 1000
    return e.groupBy(t.day("ts").alias("day"), F.col("event_type").alias("model")).agg(F.count("*").alias("calls"), F.sum(tokens).alias("tokens"), F.round(F.sum(tokens * F.col("price")), 4).alias("cost"))


@add("f10_price_by_prefix", ", pr as (select * from (values (0, 'cl', 1.25::double), (1, 'click-through', 9.0::double), (2, 'err', 0.5::double)) v(ord, prefix, price)) select event_type, (select arg_min(price, ord) from pr where starts_with(event_type, prefix) or starts_with(prefix, event_type)) as price from (select distinct event_type from events)")
def f10(spark, sf):
    """The price list has a row per model: a driver constant of three rows."""
    pr = spark.createDataFrame([(0, "cl", 1.25), (1, "click-through", 9.0), (2, "err", 0.5)], "ord int, prefix string, price double")
    e = t.table(spark, sf, "events").select("event_type").distinct()
    hit = e.join(F.broadcast(pr), F.col("event_type").startswith(F.col("prefix")) | F.col("prefix").startswith(F.col("event_type")), "left")
    return hit.groupBy("event_type").agg(F.min_by("price", "ord").alias("price"))


@add("a15_weekly_rollup", "select event_type, count(*) as n, count(*) filter (ts >= timestamp '2024-01-23') as last_week, max(strftime(ts, '%Y-%m-%d')) as latest from events group by 1")
def a15(spark, sf):
    return t.table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("ts") >= F.lit("2024-01-23").cast("timestamp_ntz")).alias("last_week"), F.max(t.day("ts")).alias("latest"))


@add("a20_yield", FEEDS + " select run_date, feed_name, case when docs_fetched > 0 then round(fetch_errors::double / docs_fetched, 6) end as yield from feeds")
def a20(spark, sf):
    return feeds(spark, sf).select("run_date", "feed_name", F.when(F.col("docs_fetched") > 0, F.round(F.col("fetch_errors") / F.col("docs_fetched"), 6)).alias("yield"))


@add("a21_ratio_per_day", FEEDS + " select run_date, sum(docs_fetched)::bigint as fetched, sum(fetch_errors)::bigint as errors, round(sum(fetch_errors)::double / greatest(sum(docs_fetched) + sum(fetch_errors), 1), 6) as ratio from feeds group by 1")
def a21(spark, sf):
    f, e = F.sum("docs_fetched"), F.sum("fetch_errors")
    return feeds(spark, sf).groupBy("run_date").agg(f.alias("fetched"), e.alias("errors"), F.round(e / F.greatest(f + e, F.lit(1)), 6).alias("ratio"))


@add("a22_latency_median", ", x as (select event_type, hour(ts) as h from events), l as (select event_type, list(h order by h) as v from x group by 1) select event_type, cast(v[len(v) // 2 + 1] as bigint) as median_hours from l")
def a22(spark, sf):
    w = Window.partitionBy("event_type")
    x = t.table(spark, sf, "events").select("event_type", F.hour("ts").cast("long").alias("h"))
    x = x.groupBy("event_type", "h").agg(F.count("*").alias("c")).withColumn("upto", F.sum("c").over(w.orderBy("h"))).withColumn("n", F.sum("c").over(w))
    return x.where("upto > n div 2").groupBy("event_type").agg(F.min("h").alias("median_hours"))


@add("a23_source_quality", "select source, sum(quality)::bigint as good, count(*) as docs, round(sum(quality)::double / count(*), 6) as ratio from documents join labels using (doc_id) group by 1 having count(*) > 0")
def a23(spark, sf):
    d = t.table(spark, sf, "documents").select("doc_id", "source").join(t.table(spark, sf, "labels"), "doc_id")
    return d.groupBy("source").agg(F.sum("quality").alias("good"), F.count("*").alias("docs"), F.round(F.sum("quality") / F.count("*"), 6).alias("ratio")).where("docs > 0")


@add("a24_extraction_quality", "select source, count(*) as docs, round(coalesce(sum(quality), 0)::double / count(*), 6) as avg_quality_score from documents left join labels using (doc_id) group by 1")
def a24(spark, sf):
    """Missing scores count as zero: the sum over all documents."""
    d = t.table(spark, sf, "documents").select("doc_id", "source").join(t.table(spark, sf, "labels"), "doc_id", "left")
    return d.groupBy("source").agg(F.count("*").alias("docs"), F.round(F.coalesce(F.sum("quality"), F.lit(0)) / F.count("*"), 6).alias("avg_quality_score"))


@add("a26_funnel", FEEDS + ", s as (select run_date, sum(docs_fetched)::bigint as a, sum(fetch_errors)::bigint as b from feeds group by 1) select run_date, 'fetched' as stage, a as docs from s union all select run_date, 'failed', b from s union all select run_date, 'all', a + b from s")
def a26(spark, sf):
    s = feeds(spark, sf).groupBy("run_date").agg(F.sum("docs_fetched").alias("a"), F.sum("fetch_errors").alias("b"))
    return s.select("run_date", F.expr("stack(3, 'fetched', a, 'failed', b, 'all', a + b) as (stage, docs)"))


@add("a31_staleness", FEEDS + " select feed_name, max(run_date) as latest, cast(date_diff('day', cast(max(run_date) as date), date '2024-02-02') > 2 as int) as alert from feeds group by 1")
def a31(spark, sf):
    age = F.datediff(F.lit("2024-02-02").cast("date"), F.max("run_date").cast("date"))
    return feeds(spark, sf).groupBy("feed_name").agg(F.max("run_date").alias("latest"), (age > 2).cast("int").alias("alert"))


@add("a32_benchmark_summary", "select event_type, round(avg(value), 4) as mean, round(median(value), 4) as median, round(stddev_samp(value), 4) as stdev from events group by 1")
def a32(spark, sf):
    v = F.col("value")
    return t.table(spark, sf, "events").groupBy("event_type").agg(F.round(F.avg(v), 4).alias("mean"), F.round(F.median(v), 4).alias("median"), F.round(F.stddev_samp(v), 4).alias("stdev"))


@add("a32_p95", ", l as (select event_type, list(value order by value) as v from events where value is not null group by 1) select event_type, v[len(v) // 2 + 1] as middle, v[cast(floor(len(v) * 0.95::double) as int) + 1] as p95 from l")
def a32_p95(spark, sf):
    """By index, as the summaries have it; no group is ordered in one task."""
    return trend.by_index(t.table(spark, sf, "events"), "event_type", "value", middle="n div 2", p95="floor(n * 0.95D)")


@add("a33_pass_rates", "select lang, round(avg(quality), 6) as pass_rate, array_to_string(list_sort(list_distinct(list(toxic)))::varchar[], ',') as seen from documents join labels using (doc_id) group by 1")
def a33(spark, sf):
    d = t.table(spark, sf, "documents").select("doc_id", "lang").join(t.table(spark, sf, "labels"), "doc_id")
    return d.groupBy("lang").agg(F.round(F.avg("quality"), 6).alias("pass_rate"), F.array_join(F.array_sort(F.collect_set("toxic")).cast("array<string>"), ",").alias("seen"))


@add("w3_error_streaks", FEEDS + ", x as (select *, sum(cast(fetch_errors = 0 as int)) over (partition by feed_name order by run_date desc) as clean from feeds) select feed_name, count(*) filter (clean = 0) as streak from x group by 1")
def w3(spark, sf):
    w = Window.partitionBy("feed_name").orderBy(F.desc("run_date")).rowsBetween(Window.unboundedPreceding, 0)
    x = feeds(spark, sf).withColumn("clean", F.sum((F.col("fetch_errors") == 0).cast("int")).over(w))
    return x.groupBy("feed_name").agg(F.count_if(F.col("clean") == 0).alias("streak"))


@add("w4_baseline_drop", FEEDS + ", x as (select *, row_number() over (partition by feed_name order by run_date desc) as n from feeds) select feed_name, max(docs_fetched) filter (n = 1) as newest, round(avg(docs_fetched) filter (n > 1), 6) as baseline, cast(max(docs_fetched) filter (n = 1) < 0.7 * avg(docs_fetched) filter (n > 1) as int) as dropped from x group by 1")
def w4(spark, sf):
    x = feeds(spark, sf).withColumn("n", F.row_number().over(Window.partitionBy("feed_name").orderBy(F.desc("run_date"))))
    new, base = F.max(F.when(F.col("n") == 1, F.col("docs_fetched"))), F.avg(F.when(F.col("n") > 1, F.col("docs_fetched")))
    return x.groupBy("feed_name").agg(new.alias("newest"), F.round(base, 6).alias("baseline"), (new < 0.7 * base).cast("int").alias("dropped"))


@add("s1_decode_json", "select event_id, cast(props->>'k' as int) as k from events where event_type = 'click'")
def s1(spark, sf):
    e = t.table(spark, sf, "events").where("event_type = 'click'")
    return e.select("event_id", F.from_json("props", "map<string,int>")["k"].alias("k"))


@add("s7_parallel_arrays", ", a as (select l_orderkey, list(l_partkey order by l_partkey, l_suppkey) as parts, list(l_returnflag order by l_partkey, l_suppkey) as flags from lineitem group by 1) select l_orderkey, unnest(parts) as part, unnest(flags) as flag from a")
def s7(spark, sf):
    a = t.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey", "l_returnflag"))).alias("x"))
    z = a.select("l_orderkey", F.explode(F.arrays_zip(F.col("x.l_partkey").alias("part"), F.col("x.l_returnflag").alias("flag"))).alias("z"))
    return z.select("l_orderkey", F.col("z.part").alias("part"), F.col("z.flag").alias("flag"))


@add("s8_boolean_tree", "select doc_id from tdocs where (contains(lower(text), 'ing') or contains(lower(text), 'ung')) and (contains(lower(text), 'the') or contains(lower(text), 'der')) and published_at >= '2024-01-10'")
def s8(spark, sf):
    from functools import reduce

    low = F.lower("text")
    tree = [["ing", "ung"], ["the", "der"]]
    cond = reduce(lambda a, b: a & b, (reduce(lambda a, b: a | b, (low.contains(w) for w in g)) for g in tree))
    return t.text_documents(spark, sf).where(cond & (F.col("published_at") >= "2024-01-10")).select("doc_id")


@add("s19_table_counts", "select 'docs' as name, count(*) as n from docs union all select 'relations', count(*) from relations union all select 'entities', count(*) from entities")
def s19(spark, sf):
    one = lambda n, d: d.agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n")
    return one("docs", t.documents(spark, sf)).union(one("relations", t.relations(spark, sf))).union(one("entities", t.entities(spark, sf)))


@add("s23_feed_diagnosis", "select source, count(*) as entries, count(l.doc_id) as archived, count(*) - count(l.doc_id) as fresh from documents d left join labels l using (doc_id) group by 1")
def s23(spark, sf):
    d = t.table(spark, sf, "documents").select("doc_id", "source").join(t.table(spark, sf, "labels").select("doc_id", F.lit(1).alias("has")), "doc_id", "left")
    return d.groupBy("source").agg(F.count("*").alias("entries"), F.count("has").alias("archived"), (F.count("*") - F.count("has")).alias("fresh"))


@add("p11_pattern_classes", "select o_orderkey, case when o_orderpriority like '%URGENT' then 'now' when o_orderpriority like '2%' then 'soon' else 'later' end as class from orders")
def p11(spark, sf):
    p = F.col("o_orderpriority")
    return t.table(spark, sf, "orders").select("o_orderkey", F.when(p.like("%URGENT"), "now").when(p.like("2%"), "soon").otherwise("later").alias("class"))


@add("p12_error_classes", "select event_id, case when regexp_matches(cast(event_id as varchar), '429|500|502|503|504') then 'retry' when contains(cast(event_id as varchar), '403') then 'permanent' else 'other' end as class from events where event_type = 'error'")
def p12(spark, sf):
    c = F.col("event_id").cast("string")
    return t.table(spark, sf, "events").where("event_type = 'error'").select("event_id", F.when(c.rlike("429|500|502|503|504"), "retry").when(c.contains("403"), "permanent").otherwise("other").alias("class"))


@add("j20_exploded_lists", ", s as (select unnest(range(o_orderkey, o_orderkey + 2)) as k from orders where o_orderstatus = 'P') select o_orderkey from orders where o_orderkey not in (from s)")
def j20(spark, sf):
    o = t.table(spark, sf, "orders")
    used = o.where("o_orderstatus = 'P'").select(F.explode(F.from_json(F.concat(F.lit("["), "o_orderkey", F.lit(","), F.col("o_orderkey") + 1, F.lit("]")), "array<bigint>")).alias("o_orderkey"))
    return o.join(used, "o_orderkey", "left_anti").select("o_orderkey")


@add("f23_suggestions", FEEDS + ", x as (select feed_name, sum(fetch_errors)::double / greatest(sum(docs_fetched), 1) as rate from feeds group by 1) select feed_name, round(rate, 6) as rate, case when rate > 0.3 then 'high' when rate > 0.2 then 'medium' else 'low' end as severity from x")
def f23(spark, sf):
    rate = F.sum("fetch_errors") / F.greatest(F.sum("docs_fetched"), F.lit(1))
    x = feeds(spark, sf).groupBy("feed_name").agg(rate.alias("r"))
    return x.select("feed_name", F.round("r", 6).alias("rate"), F.when(F.col("r") > 0.3, "high").when(F.col("r") > 0.2, "medium").otherwise("low").alias("severity"))
