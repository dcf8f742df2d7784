"""Log lines of daily runs, made of the events, as numbers and as a funnel."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidegraph.operators import logs
from tidegraph.plans.registry import add
from tidegraph.sources import shared
from tidegraph.sources import testdata as t

#: What a day's stages print: per feed its documents and errors, then what is bundled, extracted and imported.
DAYS = """, fd as (select strftime(ts, '%Y-%m-%d') as run_date, user_id % 7 as feed, count(*) filter (event_type <> 'error') as ok, count(*) filter (event_type = 'error') as bad, count(*) filter (event_type = 'view') as seen from events group by 1, 2),
dy as (select run_date, count(*) as feeds, sum(ok)::bigint as ok, sum(bad)::bigint as bad, sum(seen)::bigint as seen, count(*) filter (bad > 5) as down, sum(case when bad <= 5 then ok else 0 end)::bigint as found, sum(case when bad <= 5 then seen else 0 end)::bigint as twice, sum(case when bad between 1 and 5 then bad else 0 end)::bigint as failed from fd group by 1),
nb as (select run_date, 'ingest' as stage, unnest([('feedsChecked', feeds), ('feedsReachable', feeds - down), ('feedsUnreachable', down), ('newDocsFound', found), ('duplicatesSkipped', twice), ('fetchErrors', failed + down)]) as x from dy
  union all select run_date, 'docpack', unnest([('docsBundled', ok // 2), ('qualifiedTotal', ok), ('qualifiedExcluded', ok - ok // 2)]) from dy
  union all select run_date, 'extract', unnest([('docsExtracted', ok // 3), ('validationErrors', bad), ('escalated', seen // 2), ('entitiesFound', ok + bad), ('relationsFound', 3 * seen)]) from dy
  union all select run_date, 'import', unnest([('filesImported', ok // 4), ('entitiesNew', seen), ('entitiesResolved', bad), ('relations', ok), ('mentionsGenerated', 0), ('evidenceRecords', 2 * ok)]) from dy)"""


def written(spark, sf) -> str:
    """Writes the log files; their path."""
    e = t.table(spark, sf, "events").groupBy(t.day("ts").alias("run_date"), (F.col("user_id") % 7).alias("feed")).agg(
        F.count_if(F.col("event_type") != "error").alias("ok"), F.count_if(F.col("event_type") == "error").alias("bad"), F.count_if(F.col("event_type") == "view").alias("seen")
    )
    say = F.format_string
    tail = F.when(F.col("bad") > 5, say("  Feed CRASHED: feed%s", "feed")).when(F.col("bad") > 0, say("  Feed errors: %s fetch errors, %s saved, %s duplicates skipped", "bad", "ok", "seen")).otherwise(say("  Feed OK: %s new documents, %s duplicates skipped", "ok", "seen"))
    ingest = e.groupBy("run_date").agg(F.array_join(F.array_sort(F.collect_list(F.concat(say("[%s/7] Processing feed: feed%s (limit 50)\n", F.col("feed") + 1, "feed"), tail))), "\n").alias("text")).withColumn("stage", F.lit("ingest"))  # 7 feeds
    d = e.groupBy("run_date").agg(F.sum("ok").alias("ok"), F.sum("bad").alias("bad"), F.sum("seen").alias("seen"))
    half = lambda c, n: F.expr(f"{c} div {n}")
    texts = {
        "docpack": say("Bundled 0 documents\nQualified: %s total, %s excluded by budget\nBundled %s documents into 2 files", "ok", F.col("ok") - half("ok", 2), half("ok", 2)),
        "extract": say("  a.json OK (%s entities, %s relations)\n  b.json OK (%s entities, %s relations)\nDone. Succeeded: %s, Failed: %s, Escalated: %s/%s", "ok", "seen", "bad", F.col("seen") * 2, half("ok", 3), "bad", half("seen", 2), "ok"),
        "import": say("Imported %s extraction files\n- entities: %s new, %s resolved\n- %s relations\n- %s evidence records", half("ok", 4), "seen", "bad", "ok", F.col("ok") * 2),
    }
    rows = ingest.select("run_date", "stage", "text")
    for stage, text in texts.items():
        rows = rows.union(d.select("run_date", F.lit(stage), text))
    path = f"{shared.shared_dir(spark)}/tidegraph/logs-{uuid.uuid4().hex}"
    rows.select("run_date", "stage", "text").write.partitionBy("run_date", "stage").text(path)
    return path


def found(spark, sf):
    return logs.numbers(logs.read_lines(spark, written(spark, sf)))


@add("f15_log_numbers", DAYS + " select run_date, stage, x[1] as name, x[2]::bigint as value from nb")
def f15(spark, sf):
    return found(spark, sf)


@add("a26_stage_funnel", DAYS + """, fn as (select run_date, unnest([('ingest', 0, found), ('docpack', 1, ok // 2), ('extract', 2, ok // 3), ('import', 3, ok // 4)]) as x, found from dy)
select run_date, x[1] as stage, x[2]::int as place, x[3]::bigint as docs, case when found > 0 then round(x[3]::double / found, 6) end as kept from fn""")
def a26_stages(spark, sf):
    """The funnel of real stages, from what they printed."""
    return logs.funnel(found(spark, sf))
