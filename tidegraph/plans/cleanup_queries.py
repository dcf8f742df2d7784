"""Cleaning, lookups, cluster summaries, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegraph.operators import cleanup as c
from tidegraph.plans.health_queries import FEEDS, feeds
from tidegraph.plans.registry import add
from tidegraph.plans.resolve_queries import NAMES, SIM, names
from tidegraph.sources import testdata as t


@add("e3_canonical_types", "select event_id, case lower(event_type) when 'click' then 'Click' when 'error' then 'Error' else event_type end as type from events")
def e3(spark, sf):
    return t.table(spark, sf, "events").select("event_id", c.canonical_type(F.col("event_type"), ["Click", "Error"]).alias("type"))


@add("e4_date_resolutions", ", w as (select event_id, ['day', 'week', 'decade', 'exact', 'approximate', 'soon'][event_id % 6 + 1] as r from events) select event_id, case when r = 'day' then 'exact' when r in ('week', 'decade') then 'range' when r = 'approximate' then 'unknown' else r end as resolution from w")
def e4(spark, sf):
    written = F.element_at(F.array(*map(F.lit, ("day", "week", "decade", "exact", "approximate", "soon"))), (F.col("event_id") % 6 + 1).cast("int"))
    return t.table(spark, sf, "events").select("event_id", c.resolution(written).alias("resolution"))


@add("f12_age_hours", "select event_id, round(date_diff('second', date_trunc('second', ts), timestamp '2024-02-01') / 3600.0::double, 6) as hours from events")
def f12(spark, sf):
    return t.table(spark, sf, "events").select("event_id", F.round(c.age_hours(F.date_trunc("second", "ts"), "2024-02-01"), 6).alias("hours"))


@add("f22_snippet_caps", "select doc_id, substr(text, 1, 200) as snippet, array_to_string(string_split(text, ' ')[1:10], '|') as words from documents")
def f22(spark, sf):
    return t.table(spark, sf, "documents").select("doc_id", F.substring("text", 1, 200).alias("snippet"), F.concat_ws("|", F.slice(F.split("text", " "), 1, 10)).alias("words"))


@add("f24_trajectory", "select round(count(*)::double / count(distinct published), 6) as per_day, round(count(distinct entity_id)::double / count(*), 6) as per_doc, round(greatest(0, 500 - count(distinct entity_id)) / (count(*)::double / count(distinct published) * (count(distinct entity_id)::double / count(*))), 6) as days_to_goal from mentions")
def f24(spark, sf):
    m = t.mentions(spark, sf).agg(F.count("*").alias("d"), F.count_distinct("entity_id").alias("e"), F.count_distinct("published").alias("days"))
    day, doc = F.col("d") / F.col("days"), F.col("e") / F.col("d")
    return m.select(F.round(day, 6).alias("per_day"), F.round(doc, 6).alias("per_doc"), F.round(F.greatest(F.lit(0), 500 - F.col("e")) / (day * doc), 6).alias("days_to_goal"))


@add("j11_name_lookup", NAMES + SIM.replace("join z b on a.type = b.type and a.ord < b.ord", "join z b on a.type = b.type and a.type = 'A'") + ", al as (select name as alias, min(id) as id from nm where type = 'B' group by 1) select name as query, nm.type, al.id, 1.0::double as similarity from nm join al on alias = name union all select distinct nm.name, nm.type, b, round(s, 6) from sims join nm on nm.id = a and nm.type = sims.type where s >= 0.8 and nm.name not in (select alias from al)")
def j11(spark, sf):
    """Every name is looked up; names of type B are the aliases."""
    n = names(spark, sf)
    aliases = n.where("type = 'B'").groupBy(F.col("name").alias("alias")).agg(F.min("id").alias("id"))
    return c.lookup(n.select(F.col("name").alias("query"), "type"), n, aliases).withColumn("similarity", F.round("similarity", 6))


@add("g16_cluster_entities", ", m as (select o_custkey as cluster, 'part:' || l_partkey as entity_id, count(distinct l_orderkey) as docs_mentioning from lines group by 1, 2 having count(distinct l_orderkey) >= 2), x as (select *, row_number() over (partition by cluster order by entity_id) as n from m) select cluster, entity_id, docs_mentioning from x where n <= 30")
def g16(spark, sf):
    """The orders of a customer stand for a cluster of documents."""
    members = t.table(spark, sf, "orders").select(F.col("o_custkey").alias("cluster"), F.col("o_orderkey").alias("doc_id"))
    mentions = t.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.concat(F.lit("part:"), "l_partkey").alias("entity_id"))
    return c.shared_entities(members, mentions)


@add("d10_light_day_backfill", ", b as (select doc_id, n_chars as s from documents join labels using (doc_id) where quality = 1 order by n_chars desc, doc_id limit 20) select doc_id, s as quality_score from b where doc_id % 3 <> 0")
def d10(spark, sf):
    d = t.table(spark, sf, "documents")
    bench = d.join(t.table(spark, sf, "labels").where("quality = 1").select("doc_id"), "doc_id").select("doc_id", F.col("n_chars").alias("quality_score"))
    return c.light_day_backfill(d.where("doc_id % 3 = 0"), bench, 20)


@add("a28_f25_promotion", "select lang as model, count(*) as docs, round(avg(quality), 6) as valid_rate, round(avg(1 - toxic), 6) as entity_pct, round(avg(case when n_chars > 200 then 1 else 0 end), 6) as relation_pct, cast(avg(quality) >= 0.5 and avg(1 - toxic) >= 0.85 and avg(case when n_chars > 200 then 1 else 0 end) >= 0.8 and count(*) >= 50 as int) as promotable from documents join labels using (doc_id) group by 1")
def a28(spark, sf):
    runs = t.table(spark, sf, "documents").join(t.table(spark, sf, "labels"), "doc_id")
    runs = runs.select(F.col("lang").alias("model"), F.col("quality").alias("schema_valid"), (1 - F.col("toxic")).alias("entity_pct"), (F.col("n_chars") > 200).cast("int").alias("relation_pct"))
    return c.promotion(runs, valid=0.5, docs=50).select("model", "docs", *(F.round(k, 6).alias(k) for k in ("valid_rate", "entity_pct", "relation_pct")), "promotable")


@add("a30_normalization_coverage", "select case when event_type in ('click', 'view') then 'canonical' when event_type in ('error', 'signup') then 'normalized' else 'unknown' end as class, count(*) as n, count(distinct event_type) as forms from events group by 1")
def a30(spark, sf):
    kind = F.when(F.col("event_type").isin("click", "view"), "canonical").when(F.col("event_type").isin("error", "signup"), "normalized").otherwise("unknown")
    return t.table(spark, sf, "events").groupBy(kind.alias("class")).agg(F.count("*").alias("n"), F.count_distinct("event_type").alias("forms"))


@add("p13_integrity", "select status, count(*) as docs, count(*) filter (status = 'cleaned' and not exists (select 1 from lineitem where 'doc:' || l_orderkey = docs.doc_id)) as missing from docs group by 1")
def p13(spark, sf):
    """A document's lines stand for its text file."""
    have = t.table(spark, sf, "lineitem").select(F.concat(F.lit("doc:"), "l_orderkey").alias("doc_id"), F.lit(1).alias("there")).distinct()
    return t.documents(spark, sf).join(have, "doc_id", "left").groupBy("status").agg(F.count("*").alias("docs"), F.count_if((F.col("status") == "cleaned") & F.col("there").isNull()).alias("missing"))


@add("j19_config_feeds", FEEDS + ", cfg as (select 'feed' || i as feed_name from range(9) r(i)) select feed_name, coalesce(sum(fetch_errors), 0)::bigint as errors from cfg left join feeds using (feed_name) group by 1")
def j19(spark, sf):
    cfg = spark.range(9).select(F.concat(F.lit("feed"), "id").alias("feed_name"))
    return cfg.join(feeds(spark, sf), "feed_name", "left").groupBy("feed_name").agg(F.coalesce(F.sum("fetch_errors"), F.lit(0)).alias("errors"))


@add("m9_repair", """select page_id, case when page_id % 4 > 1 or page_id % 5 = 0 then 'kept' when page_id % 3 = 0 then 'lost' else 'recovered' end as done,
  case when page_id % 5 = 0 then 'extracted' when page_id % 4 <= 1 and page_id % 3 = 0 then 'error' else 'cleaned' end as status, cast(page_id % 4 > 1 or (page_id % 5 > 0 and page_id % 3 > 0) as int) as has_text from pages""")
def m9(spark, sf):
    k = F.col("page_id")
    d = t.table(spark, sf, "pages").select("page_id", F.when(k % 5 == 0, "extracted").otherwise("cleaned").alias("status"), F.when(k % 4 > 1, F.col("url")).alias("text"), F.when(k % 3 > 0, F.col("html")).alias("html"))
    return c.repair(d).select("page_id", "done", "status", F.col("text").isNotNull().cast("int").alias("has_text"))
