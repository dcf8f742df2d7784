"""Document selection, the bench, and changes of tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegraph.functions import scoring as s
from tidegraph.operators import selection, tables
from tidegraph.plans.registry import add
from tidegraph.sources import testdata as t

SCORED = """, w as (select *, len(list_filter(regexp_split_to_array(text, '[\\s]+'), lambda x: x <> '')) as word_count, date_diff('day', cast(published_at as date), date '2024-01-30') as age from tdocs),
p as (select *, case when word_count <= 0 then 0.0::double when word_count < 200 then 0.5::double * word_count / 200 when word_count <= 800 then 0.5::double + 0.5::double * (word_count - 200) / 600 when word_count <= 3000 then 1.0::double
    else greatest(0.7::double, 1 - 0.1::double * ln(1 + (word_count - 3000)::double / 3000)) end as word_count_score,
  case when trim(title) <> '' then 0.5::double else 0.0::double end + 0.5::double as metadata_score, case tier when 1 then 1.0::double when 2 then 0.6::double else 0.3::double end as tier_score,
  case signal when 'primary' then 1.0::double when 'commentary' then 0.8::double when 'community' then 0.6::double when 'echo' then 0.4::double else 0.5::double end as signal_score,
  case when age <= 3 then 1.0::double when age <= 7 then 1 - 0.5::double * (age - 3) / 4 when age <= 14 then 0.5::double - 0.2::double * (age - 7) / 7 else 0.3::double end as recency_score from w),
scored as (select *, round(0.30::double * word_count_score + 0.20::double * metadata_score + 0.20::double * tier_score + 0.15::double * signal_score + 0.15::double * recency_score, 6) as combined_score from p)"""
BUDGET, STRETCH = 35, 40
SELECTED = SCORED + f""", g1 as (select *, row_number() over (partition by source order by combined_score desc, doc_id) as fr from scored where combined_score >= 0.2),
g2 as (select *, fr = 1 and sum(cast(fr = 1 as int)) over (order by combined_score desc, doc_id) <= {STRETCH} as rep from g1),
g3 as (select *, sum(cast(not rep as int)) over (order by combined_score desc, doc_id) as pr, count(*) over () as n, count(*) filter (rep) over () as reps from g2),
outcomes as (select doc_id, source, combined_score, case when n <= {BUDGET} or rep or pr <= greatest({BUDGET} - reps, 0) or (pr <= {STRETCH} - reps and combined_score >= 0.55) then 'selected' else 'benched' end as outcome from g3
union all select doc_id, source, combined_score, 'rejected' from scored where combined_score < 0.2)"""


def scored(spark, sf):
    return selection.score(t.text_documents(spark, sf), t.AS_OF)


def outcomes(spark, sf):
    return selection.select(scored(spark, sf), BUDGET, STRETCH)


@add("d1_d6_document_scores", SCORED + " select doc_id, word_count, round(word_count_score, 6) as word_count_score, metadata_score, tier_score, signal_score, round(recency_score, 6) as recency_score, combined_score from scored")
def d6(spark, sf):
    return scored(spark, sf).select("doc_id", F.col("word_count").cast("long").alias("word_count"), F.round("word_count_score", 6).alias("word_count_score"), "metadata_score", "tier_score", "signal_score", F.round("recency_score", 6).alias("recency_score"), "combined_score")


@add("d7_quota_selection", SELECTED + " select * from outcomes")
def d7(spark, sf):
    return outcomes(spark, sf)


@add("d9_outcome_log", SELECTED + " select source, outcome, count(*) as n, round(avg(combined_score), 4) as mean_score from outcomes group by 1, 2")
def d9(spark, sf):
    return outcomes(spark, sf).groupBy("source", "outcome").agg(F.count("*").alias("n"), F.round(F.avg("combined_score"), 4).alias("mean_score"))


@add("d8_bench_expiry", SELECTED + ", b as (select doc_id, combined_score as quality_score, strftime(date '2024-01-01' + cast(doc_id % 40 as int), '%Y-%m-%d') as expires_at from outcomes where outcome = 'benched') select doc_id, expires_at from b where not (expires_at <= '2024-01-20')")
def d8(spark, sf):
    b = outcomes(spark, sf).where("outcome = 'benched'").withColumn("expires_at", F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 40).cast("int")), "yyyy-MM-dd"))
    return tables.delete(b, F.col("expires_at") <= "2024-01-20").select("doc_id", "expires_at")


@add("p10_bench_top", SELECTED + " select doc_id, combined_score as quality_score, title from outcomes join tdocs using (doc_id) where outcome = 'benched' order by combined_score desc, doc_id limit 10")
def p10(spark, sf):
    b = outcomes(spark, sf).where("outcome = 'benched'").select("doc_id", F.col("combined_score").alias("quality_score"), F.lit("2024-02-04").alias("expires_at"))
    return selection.bench_top(b, t.text_documents(spark, sf).select("doc_id", "title"), t.AS_OF, 10).select("doc_id", "quality_score", "title")


@add("w6_top_per_source", SCORED + " select source, doc_id, n from (select source, doc_id, row_number() over (partition by source order by combined_score desc, doc_id) as n from scored) where n <= 3")
def w6(spark, sf):
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("combined_score"), "doc_id"))
    return scored(spark, sf).select("source", "doc_id", n.alias("n")).where("n <= 3")


@add("p5_keyword_scope", "select doc_id from tdocs where (contains(lower(text), 'tion') or contains(lower(text), 'keit')) and not contains(lower(text), 'license')")
def p5(spark, sf):
    low = F.lower("text")
    return t.text_documents(spark, sf).where((low.contains("tion") | low.contains("keit")) & ~low.contains("license")).select("doc_id")


@add("p4_eligible_sources", "select doc_id from tdocs where signal not in ('echo', 'community')")
def p4(spark, sf):
    policy = spark.createDataFrame([("echo", False), ("community", False), ("primary", True)], "signal string, eligible boolean")
    d = t.text_documents(spark, sf).join(F.broadcast(policy), "signal", "left")
    return d.where(F.coalesce("eligible", F.lit(True))).select("doc_id")


@add("p6_age_cutoff", "select doc_id from tdocs where published_at >= '2024-01-16'")
def p6(spark, sf):
    d = t.text_documents(spark, sf)
    return d.where(F.coalesce(F.try_to_date("published_at", "yyyy-MM-dd") >= F.lit("2024-01-16").cast("date"), F.lit(True))).select("doc_id")


@add("p7_skip_existing", "select doc_id from tdocs where doc_id not in (select doc_id from labels)")
def p7(spark, sf):
    return t.text_documents(spark, sf).join(t.table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti").select("doc_id")


@add("p8_candidates", "select doc_id, published_at from docs where status = 'cleaned' and published_at <= '2000-01-01' order by published_at desc, doc_id limit 50")
def p8(spark, sf):
    d = t.documents(spark, sf).where("status = 'cleaned' and published_at <= '2000-01-01'")
    return d.orderBy(F.desc("published_at"), "doc_id").limit(50).select("doc_id", "published_at")


@add("p9_backlog_top_up", ", taken as (select doc_id from docs where status = 'cleaned' order by published_at desc, doc_id limit 30), more as (select doc_id from docs where published_at >= '2001-07-01' order by published_at desc, doc_id limit 60) select doc_id from more where doc_id not in (from taken)")
def p9(spark, sf):
    """The limit comes before the anti join, so fewer rows may remain."""
    d, order = t.documents(spark, sf), [F.desc("published_at"), F.col("doc_id")]
    taken = d.where("status = 'cleaned'").orderBy(*order).limit(30).select("doc_id")
    return d.where("published_at >= '2001-07-01'").orderBy(*order).limit(60).join(taken, "doc_id", "left_anti").select("doc_id")


@add("m1_replace", "select doc_id, case when published_at >= '2001-01-01' then 'seen' else status end as status from docs")
def m1(spark, sf):
    d = t.documents(spark, sf).select("doc_id", "published_at", "status")
    new = d.where("published_at >= '2001-01-01'").withColumn("status", F.lit("seen"))
    return tables.replace(d, new, ["doc_id"]).select("doc_id", "status")


@add("m2_insert_ignore", "select doc_id, case when status = 'cleaned' then 'old' else 'new' end as origin from docs")
def m2(spark, sf):
    d = t.documents(spark, sf)
    old = d.where("status = 'cleaned'").select("doc_id", F.lit("old").alias("origin"))
    return tables.insert_ignore(old, d.select("doc_id", F.lit("new").alias("origin")), ["doc_id"])


@add("m3_upsert_entities", "select entity_id, case when type = 'Part' and name like 'red%' then 'RED' else name end as name, type, first_seen, case when type = 'Part' and name like 'red%' then greatest(last_seen, '2001-09-01') else last_seen end as last_seen from entities")
def m3(spark, sf):
    e = t.entities(spark, sf)
    new = e.where("type = 'Part' and name like 'red%'").select("entity_id", F.lit("RED").alias("name"), F.lit(None).cast("string").alias("type"), F.lit("2001-01-01").alias("first_seen"), F.lit("2001-09-01").alias("last_seen"))
    return tables.upsert_entities(e, new)


@add("m6_delete", "select doc_id from docs where not (status = 'error' and published_at < '1999-01-01')")
def m6(spark, sf):
    return tables.delete(t.documents(spark, sf), (F.col("status") == "error") & (F.col("published_at") < "1999-01-01")).select("doc_id")


@add("m7_status_lifecycle", "select doc_id, case when o_totalprice > 400000 then 'shelved' when o_orderstatus = 'F' then 'extracted' else 'error' end as status from docs join orders on doc_id = 'doc:' || o_orderkey")
def m7(spark, sf):
    o = t.table(spark, sf, "orders")
    return o.select(F.concat(F.lit("doc:"), "o_orderkey").alias("doc_id"), tables.next_status(F.col("o_orderstatus") == "F", F.col("o_totalprice") > 400000).alias("status"))


@add("d4_score_tables", "select distinct tier, signal, case tier when 1 then 1.0::double when 2 then 0.6::double else 0.3::double end as tier_score, case signal when 'primary' then 1.0::double when 'commentary' then 0.8::double when 'community' then 0.6::double when 'echo' then 0.4::double else 0.5::double end as signal_score from tdocs")
def d4(spark, sf):
    return t.text_documents(spark, sf).select("tier", "signal").distinct().select("tier", "signal", s.tier_score(F.col("tier")).alias("tier_score"), s.signal_score(F.col("signal")).alias("signal_score"))
