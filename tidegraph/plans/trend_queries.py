"""Mention windows, scores, history, ranks, movers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegraph.functions import scoring as s
from tidegraph.operators import trend
from tidegraph.plans.registry import add
from tidegraph.sources import testdata as t
from tidegraph.sources.shared import materialise

P = s.Profile()
RUNS = ["2024-01-09", "2024-01-16", "2024-01-23", "2024-01-30"]


def counts_sql(as_of: str, name: str) -> str:
    b = trend.back
    return f"""{name} as (select entity_id,
  count(*) filter (published between '{b(as_of, 7)}' and '{as_of}') as c7,
  count(*) filter (published between '{b(as_of, 14)}' and '{b(as_of, 7)}') as p7,
  count(*) filter (published between '{b(as_of, 30)}' and '{as_of}') as c30,
  count(*) filter (published between '{b(as_of, P.max_age)}' and '{as_of}') as c_max,
  min(published) as first_seen from mentions where published <= '{as_of}' group by 1)"""


def scores_sql(as_of: str, name: str) -> str:
    return f"""{counts_sql(as_of, name + '_w')}, {name} as (select *,
  {P.w_velocity} * least(velocity, {P.velocity_cap}) / {P.velocity_cap} + {P.w_novelty} * novelty + {P.w_activity} * least(c7, {P.activity_cap}) / {P.activity_cap} as trend_score
  from (select *, cast(c7 > 0 and c7 < {P.min_mentions} as int) as velocity_gated,
    case when c7 > 0 and c7 < {P.min_mentions} then 1.0::double when c7 = 0 and p7 = 0 then 0.0::double when p7 = 0 then least(c7::double, {P.velocity_cap}) else c7::double / p7 end as velocity,
    {P.w_age} * exp(-{P.decay}::double * greatest(0, date_diff('day', cast(first_seen as date), date '{as_of}'))) + {P.w_rarity} * (ln(1 + n::double / (1 + c_max)) / ln(1 + n::double)) as novelty
    from {name}_w, (select count(*) as n from {name}_w)))"""


HISTORY_SQL = ", " + ", ".join(scores_sql(r, f"h{i}") for i, r in enumerate(RUNS)) + ", history as (" + " union all ".join(
    f"select entity_id, '{r}' as run_date, c7 as mention_count_7d, c30 as mention_count_30d, velocity, round(novelty, 6) as novelty, velocity_gated, "
    f"case when c7 >= {P.min_mentions} then round(trend_score, 6) else 0.0::double end as trend_score from h{i} where c30 > 0"
    for i, r in enumerate(RUNS)
) + "), ranked as (select *, cast(row_number() over (partition by run_date order by trend_score desc, entity_id) as int) as rank from history)"


def cube(spark, sf):
    """Day counts up to the last run; the bound reaches the scan."""
    return materialise(trend.day_counts(t.mentions(spark, sf, None, RUNS[-1])), "day_counts")


def history(spark, sf):
    return trend.history_of(cube(spark, sf), RUNS, P)


@add("a1_mention_windows", ", " + counts_sql(t.AS_OF, "w") + " select * from w")
def a1(spark, sf):
    return trend.mention_windows(t.mentions(spark, sf, None, t.AS_OF), t.AS_OF, P)


@add("r1_r4_trend_scores", ", " + scores_sql(t.AS_OF, "x") + " select entity_id, velocity, velocity_gated, round(novelty, 6) as novelty, round(trend_score, 6) as trend_score from x")
def r4(spark, sf):
    return trend.scores(t.mentions(spark, sf, None, t.AS_OF), t.AS_OF, P).select("entity_id", "velocity", "velocity_gated", F.round("novelty", 6).alias("novelty"), F.round("trend_score", 6).alias("trend_score"))


@add("w7_trending_top", ", " + scores_sql(t.AS_OF, "x") + f" select entity_id, c7, c30, velocity, round(novelty, 6) as novelty, round(trend_score, 6) as trend_score from x where c7 >= {P.min_mentions} order by x.trend_score desc, entity_id limit 20")
def w7(spark, sf):
    return trend.trending(t.mentions(spark, sf, None, t.AS_OF), t.AS_OF, P)


@add("r5_trend_history", HISTORY_SQL + " select * from history")
def r5(spark, sf):
    return history(spark, sf)


@add("w1_run_ranks", HISTORY_SQL + " select entity_id, run_date, rank from ranked")
def w1(spark, sf):
    return trend.ranks(history(spark, sf)).select("entity_id", "run_date", "rank")


_CI = "(recent + 0.5) / (previous + 0.5) * exp(-1.645 * sqrt(1 / (recent + 0.5::double) + 1 / (previous + 0.5::double)))"
MOVERS_SQL = HISTORY_SQL + f""", counts as (select entity_id, count(*) filter (published between '2024-01-23' and '2024-01-30') as recent,
  count(*) filter (published between '2024-01-16' and '2024-01-23') as previous, count(distinct case when published between '2024-01-23' and '2024-01-30' then source end) as sources
  from mentions group by 1), movers as (
select n.entity_id, n.rank, p.rank as prior_rank, p.rank - n.rank as rank_delta, cast(p.rank is null as int) as is_new,
  cast(n.velocity > 1 and coalesce(p.velocity, 0) > 1 as int) as sustained, recent, previous, sources,
  round(case when previous > 0 then recent::double / previous end, 6) as velocity_raw,
  round(case when recent > 0 or previous > 0 then {_CI} end, 6) as velocity_floor, n.trend_score
from ranked n left join ranked p on p.entity_id = n.entity_id and p.run_date = '2024-01-23' left join counts c on c.entity_id = n.entity_id where n.run_date = '2024-01-30')"""


def movers(spark, sf):
    days = cube(spark, sf)
    return trend.movers(trend.history_of(days, RUNS, P), days, "2024-01-30", P)


@add("j13_movers", MOVERS_SQL + " select * from movers")
def j13(spark, sf):
    return movers(spark, sf)


@add("j14_prior_run", HISTORY_SQL + " select max(run_date) as prior_run from history where run_date <= '2024-01-23'")
def j14(spark, sf):
    return history(spark, sf).where(F.col("run_date") <= "2024-01-23").agg(F.max("run_date").alias("prior_run"))


PRESETS = {
    "climbers": ("rank_delta > 0", ["rank_delta desc nulls last", "entity_id"]),
    "fallers": ("rank_delta < 0", ["rank_delta asc nulls last", "entity_id"]),
    "newcomers": ("is_new = 1", ["rank", "entity_id"]),
    "fast": ("velocity_floor > 1", ["velocity_floor desc nulls last", "entity_id"]),
    "broad": ("sources >= 3", ["sources desc nulls last", "entity_id"]),
    "steady": ("sustained = 1", ["rank", "entity_id"]),
}


#: Entities that come and go: a user's hours of the day, so that a run has newcomers.
HOURLY = ", hourly as (select 'user:' || user_id || ':' || hour(ts) as entity_id, event_id as doc_id, strftime(ts, '%Y-%m-%d') as published, event_type as source from events)"


def hourly_cube(spark, sf):
    e = t.table(spark, sf, "events").where(F.col("ts") < F.lit("2024-01-31").cast("timestamp"))
    return materialise(trend.day_counts(e.select(F.concat_ws(":", F.lit("user"), "user_id", F.hour("ts")).alias("entity_id"), t.day("ts").alias("published"), F.col("event_type").alias("source"))), "day_counts")


def _preset(name):
    where, order = PRESETS[name]
    fresh = name == "newcomers"
    sql = HOURLY + MOVERS_SQL.replace("from mentions", "from hourly") if fresh else MOVERS_SQL

    @add(f"p19_movers_{name}", sql + f" select entity_id, rank, trend_score from (select * from movers where {where} order by {', '.join(order)} limit 25)")
    def p19(spark, sf):
        days = hourly_cube(spark, sf) if fresh else cube(spark, sf)
        rows = trend.movers(trend.history_of(days, RUNS, P), days, "2024-01-30", P)
        return rows.where(where).orderBy(*map(_order, order)).limit(25).select("entity_id", "rank", "trend_score")


def _order(text):
    parts = text.split()
    c = F.col(parts[0])
    return c.desc_nulls_last() if parts[1:2] == ["desc"] else c.asc_nulls_last()


for _name in PRESETS:
    _preset(_name)


@add("w8_top_overlap", HISTORY_SQL + """, top as (select run_date, entity_id from ranked where rank <= 10), pr as (select run_date, lag(run_date) over (order by run_date) as prior from (select distinct run_date from history))
select pr.run_date, pr.prior, count(b.entity_id) as shared, count(b.entity_id)::double / greatest(count(*), max(m.n)) as overlap
from pr join top a using (run_date) left join top b on b.run_date = pr.prior and b.entity_id = a.entity_id join (select run_date, count(*) as n from top group by 1) m on m.run_date = pr.prior
where prior is not null group by 1, 2""")
def w8(spark, sf):
    return trend.run_overlap(history(spark, sf))


@add("a3_distinct_sources", "select entity_id, count(distinct source) as sources from mentions where published between '2024-01-23' and '2024-01-30' group by 1")
def a3(spark, sf):
    return t.mentions(spark, sf, trend.back(t.AS_OF, 7), t.AS_OF).groupBy("entity_id").agg(F.count_distinct("source").alias("sources"))


@add("a2_window_counts", "select entity_id, count(*) as n from mentions where published between '2024-01-10' and '2024-01-20' group by 1")
def a2(spark, sf):
    return t.mentions(spark, sf, "2024-01-10", "2024-01-20").groupBy("entity_id").agg(F.count("*").alias("n"))


@add("a17_gated_share", HISTORY_SQL + " select run_date, avg(velocity_gated) as share from history where run_date = (select max(run_date) from history) group by 1")
def a17(spark, sf):
    h = history(spark, sf)
    return h.join(F.broadcast(h.agg(F.max("run_date").alias("run_date"))), "run_date").groupBy("run_date").agg(F.avg("velocity_gated").alias("share"))


@add("a18_novelty_quantiles", HISTORY_SQL + """, l as (select run_date, list(novelty order by novelty) as v from history group by 1 having count(*) >= 4)
select run_date, v[len(v) // 10 + 1] as p10, v[len(v) // 4 + 1] as p25, v[len(v) // 2 + 1] as p50, v[3 * len(v) // 4 + 1] as p75, v[9 * len(v) // 10 + 1] as p90 from l""")
def a18(spark, sf):
    """By index, from places: no list is gathered, and no run is ordered in one task."""
    return trend.by_index(history(spark, sf), "run_date", "novelty", 4, p10="n div 10", p25="n div 4", p50="n div 2", p75="3 * n div 4", p90="9 * n div 10")


@add("a16_readiness", HISTORY_SQL + " select max(run_date) as latest, count(distinct run_date) as runs, count(*) filter (run_date = '2024-01-30') as entities, round(max(trend_score), 6) as top from history")
def a16(spark, sf):
    return history(spark, sf).agg(F.max("run_date").alias("latest"), F.count_distinct("run_date").alias("runs"), F.count_if(F.col("run_date") == "2024-01-30").alias("entities"), F.round(F.max("trend_score"), 6).alias("top"))


@add("a19_corpus_per_run", HISTORY_SQL + " select run_date, count(*) as entities, any_value(run_date) as any_run from history group by 1")
def a19(spark, sf):
    return history(spark, sf).groupBy("run_date").agg(F.count("*").alias("entities"), F.any_value("run_date").alias("any_run"))


@add("j15_run_pairs", HISTORY_SQL + " select run_date, lag(run_date) over (order by run_date) as prior from (select distinct run_date from history)")
def j15(spark, sf):
    return history(spark, sf).select("run_date").distinct().withColumn("prior", F.lag("run_date").over(Window.orderBy("run_date")))


@add("w5_velocity_changes", HISTORY_SQL + " select entity_id, run_date, velocity - lag(velocity) over (partition by entity_id order by run_date) as change, cast(velocity > 1 and lag(velocity) over (partition by entity_id order by run_date) > 1 as int) as sustained from history")
def w5(spark, sf):
    was = F.lag("velocity").over(Window.partitionBy("entity_id").orderBy("run_date"))
    return history(spark, sf).select("entity_id", "run_date", (F.col("velocity") - was).alias("change"), ((F.col("velocity") > 1) & (was > 1)).cast("int").alias("sustained"))


@add("r8_first_seen_age", "select entity_id, min(published) as first_seen, greatest(0, date_diff('day', cast(min(published) as date), date '2024-01-30')) as days from mentions group by 1")
def r8(spark, sf):
    days = F.greatest(F.lit(0), F.datediff(F.lit(t.AS_OF).cast("date"), F.min("published").cast("date"))).cast("long")
    return t.mentions(spark, sf).groupBy("entity_id").agg(F.min("published").alias("first_seen"), days.alias("days"))


@add("u4_churn", HISTORY_SQL + " select count(*) as stayed from (select entity_id from history where run_date = '2024-01-23' intersect select entity_id from history where run_date = '2024-01-30')")
def u4(spark, sf):
    h = history(spark, sf)
    day = lambda d: h.where(F.col("run_date") == d).select("entity_id")
    return day("2024-01-23").intersect(day("2024-01-30")).agg(F.count("*").alias("stayed"))


@add("u3_new_entities", HOURLY + HISTORY_SQL.replace("from mentions", "from hourly") + " select entity_id from history where run_date = '2024-01-16' except select entity_id from history where run_date = '2024-01-09'")
def u3(spark, sf):
    h = trend.history_of(hourly_cube(spark, sf), RUNS, P)
    day = lambda d: h.where(F.col("run_date") == d).select("entity_id")
    return day("2024-01-16").join(day("2024-01-09"), "entity_id", "left_anti").distinct()
