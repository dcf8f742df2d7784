"""Mention windows, trend scores, ranks and movers."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegraph.functions import scoring as s
from tidegraph.sources.shared import materialise


def back(as_of: str, days: int) -> str:
    return (date.fromisoformat(as_of) - timedelta(days=days)).isoformat()


def in_window(as_of: str, days: int, column: str = "published"):
    """Closed at both ends and compared as text: a datetime on the last day falls out."""
    return F.col(column).between(back(as_of, days), as_of)


def first_day(column: str = "published"):
    """The first day of a group as text, by dates: a minimum of texts would need sorted groups."""
    return F.date_format(F.min(F.try_to_date(F.substring(column, 1, 10), "yyyy-MM-dd")), "yyyy-MM-dd")


def day_counts(mentions: DataFrame) -> DataFrame:
    """The cube of mentions: (entity_id, published, source, n). Windows, histories and movers of any run date come from it."""
    return mentions.groupBy("entity_id", "published", "source").agg(F.count("*").alias("n"))


def merge_counts(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The cube after a batch of mentions, late days included; only the batch's own mentions are read."""
    return stored.unionByName(day_counts(batch)).groupBy("entity_id", "published", "source").agg(F.sum("n").alias("n"))


def mention_windows(mentions: DataFrame, as_of: str, p: s.Profile) -> DataFrame:
    """One pass: mentions per entity in the last 7 days, the 7 before, 30 and max_age days; first day."""
    count = lambda at, days: F.count_if(in_window(at, days))
    return mentions.groupBy("entity_id").agg(
        count(as_of, 7).alias("c7"),
        count(back(as_of, 7), 7).alias("p7"),
        count(as_of, 30).alias("c30"),
        count(as_of, p.max_age).alias("c_max"),
        first_day().alias("first_seen"),
    )


def scores(mentions: DataFrame, as_of: str, p: s.Profile) -> DataFrame:
    """velocity, novelty and trend_score of every entity; the corpus size is counted once."""
    w = mention_windows(mentions, as_of, p)
    n = mentions.agg(F.count_distinct("entity_id").alias("corpus"))
    w = w.crossJoin(F.broadcast(n))  # one row
    v = w.withColumn("velocity", s.velocity(F.col("c7"), F.col("p7"), p)).withColumn(
        "novelty", s.novelty(F.col("first_seen"), F.col("c_max"), F.col("corpus"), as_of, p)
    )
    return v.withColumn("velocity_gated", s.velocity_gated(F.col("c7"), p)).withColumn(
        "trend_score", s.trend_score(F.col("velocity"), F.col("novelty"), F.col("c7"), p)
    )


def trending(mentions: DataFrame, as_of: str, p: s.Profile, k: int = 20) -> DataFrame:
    """Top k by score, ties by entity_id."""
    return (
        scores(mentions, as_of, p)
        .where(F.col("c7") >= p.min_mentions)
        .orderBy(F.desc("trend_score"), "entity_id")
        .limit(k)
        .select("entity_id", "c7", "c30", "velocity", F.round("novelty", 6).alias("novelty"), F.round("trend_score", 6).alias("trend_score"))
    )


def hot_list(scored: DataFrame, mentions: DataFrame, k: int = 10, most: int = 3) -> DataFrame:
    """The k best moving or scored entities, with up to `most` of their sources by name."""
    top = scored.where("velocity > 0 or trend_score > 0").orderBy(F.desc("trend_score"), "entity_id").limit(k)
    of_top = mentions.join(F.broadcast(top.select("entity_id")), "entity_id", "left_semi")  # k ids
    sources = of_top.groupBy("entity_id").agg(F.array_sort(F.collect_set("source")).alias("all"))
    return top.join(sources, "entity_id", "left").select(
        "entity_id", "velocity", F.round("trend_score", 6).alias("trend_score"), F.array_join(F.slice("all", 1, most), ",").alias("sources")
    )


def history(mentions: DataFrame, runs: list[str], p: s.Profile) -> DataFrame:
    """Rows of trend history for several run dates, from one scan of the mentions."""
    return history_of(materialise(day_counts(mentions.where(F.col("published") <= max(runs))), "day_counts"), runs, p)


def history_of(cube: DataFrame, runs: list[str], p: s.Profile) -> DataFrame:
    """Rows of trend history for several run dates: entities with mentions in 30 days; below the minimum the score is 0.

    cube: see day_counts. A day counts for each run that is not before it, and for those of the
    run's windows that it lies in; all runs are one aggregation, whatever their number.
    """
    frames = F.array(*(F.struct(F.lit(r).alias("run_date"), *(F.lit(back(r, d)).alias(f"d{d}") for d in sorted({7, 14, 30, p.max_age}))) for r in sorted(set(runs))))
    later = F.explode(F.filter(frames, lambda f: f["run_date"] >= F.col("published"))).alias("run")
    of = cube.groupBy("entity_id", "published").agg(F.sum("n").alias("n")).select("entity_id", "published", "n", later)

    def count(start: int, end: int = 0):
        last = F.col("run.run_date") if not end else F.col(f"run.d{end}")
        return F.coalesce(F.sum(F.when(F.col("published").between(F.col(f"run.d{start}"), last), F.col("n"))), F.lit(0))

    w = of.groupBy("entity_id", F.col("run.run_date").alias("run_date")).agg(
        count(7).alias("c7"), count(14, 7).alias("p7"), count(30).alias("c30"), count(p.max_age).alias("c_max"), first_day().alias("first_seen")
    )
    corpus = of.select("entity_id", F.col("run.run_date").alias("run_date")).distinct().groupBy("run_date").agg(F.count("*").alias("corpus"))
    w = w.where("c30 > 0").join(F.broadcast(corpus), "run_date")  # a row per run
    v = w.withColumn("velocity", s.velocity(F.col("c7"), F.col("p7"), p)).withColumn("novelty", s.novelty(F.col("first_seen"), F.col("c_max"), F.col("corpus"), F.col("run_date"), p))
    return v.select(
        "entity_id", "run_date", F.col("c7").alias("mention_count_7d"), F.col("c30").alias("mention_count_30d"), "velocity", F.round("novelty", 6).alias("novelty"),
        s.velocity_gated(F.col("c7"), p).alias("velocity_gated"),
        F.when(F.col("c7") >= p.min_mentions, F.round(s.trend_score(F.col("velocity"), F.col("novelty"), F.col("c7"), p), 6)).otherwise(0.0).alias("trend_score"),
    )


def places(rows: DataFrame, group: str, *order) -> DataFrame:
    """rows with `place`, from 0, in the order of their group.

    Rows are dealt to ranges of that order and written; a place is one within the range plus
    the rows of the group in earlier ranges, so no task orders a whole group.
    """
    dealt = materialise(rows.repartitionByRange(group, *order).withColumn("range", F.spark_partition_id()), "ranges")
    before = F.sum("n").over(Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    start = dealt.groupBy(group, "range").agg(F.count("*").alias("n")).select(group, "range", F.coalesce(before, F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy(group, "range").orderBy(*order))
    return dealt.withColumn("own", own).join(start, [group, "range"]).withColumn("place", F.col("own") + F.col("start") - 1).drop("range", "own", "start")


def by_index(rows: DataFrame, group: str, value: str, least: int = 1, **picks: str) -> DataFrame:
    """(group, picks): of every group the values at the places that the picks name, as expressions of its size n, in the order of value.

    Nulls of value are left out, and groups of fewer than `least` values.
    """
    rows = rows.select(group, value).where(F.col(value).isNotNull())
    placed = places(rows, group, value)
    sizes = placed.groupBy(group).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    wanted = sizes.select(group, F.explode(F.array(*(F.struct(F.lit(k).alias("pick"), F.expr(e).cast("long").alias("place")) for k, e in picks.items()))).alias("w")).select(group, "w.*")
    found = placed.join(F.broadcast(wanted), [group, "place"])  # some rows for each group
    return found.groupBy(group).agg(*(F.max(F.when(F.col("pick") == k, F.col(value))).alias(k) for k in picks))


def ranks(rows: DataFrame) -> DataFrame:
    """Place of every entity in its run, from 1, by score, ties by entity_id."""
    return places(rows, "run_date", F.desc("trend_score"), "entity_id").withColumn("rank", (F.col("place") + 1).cast("int")).drop("place")


def prior_run(rows: DataFrame, latest: str, days: int = 7) -> str | None:
    """The last run at least `days` before the latest one: a named scalar."""
    return rows.where(F.col("run_date") <= back(latest, days)).agg(F.max("run_date")).first()[0]


def movers(rows: DataFrame, cube: DataFrame, latest: str, p: s.Profile, days: int = 7) -> DataFrame:
    """Rank changes against the prior run, with raw velocity and its lower bound, and sources in the window.

    rows: trend history; cube: see day_counts, of which only the days of both windows are read.
    """
    rows = materialise(rows, "history")
    prior = prior_run(rows, latest, days)
    ranked = ranks(rows.where(F.col("run_date").isin(latest, prior or latest)))
    now = ranked.where(F.col("run_date") == latest)
    was = ranked.where(F.col("run_date") == F.lit(prior)).select("entity_id", F.col("rank").alias("prior_rank"), F.col("velocity").alias("prior_velocity"))
    counts = cube.where(F.col("published").between(back(latest, 2 * days), latest)).groupBy("entity_id").agg(
        F.sum(F.when(in_window(latest, days), F.col("n"))).alias("recent"),
        F.sum(F.when(in_window(back(latest, days), days), F.col("n"))).alias("previous"),
        F.count_distinct(F.when(in_window(latest, days), F.col("source"))).alias("sources"),
    )
    j = now.join(was, "entity_id", "left").join(counts, "entity_id", "left").fillna(0, ["recent", "previous", "sources"])
    return j.select(
        "entity_id", "rank", "prior_rank", (F.col("prior_rank") - F.col("rank")).alias("rank_delta"), F.col("prior_rank").isNull().cast("int").alias("is_new"),
        ((F.col("velocity") > 1) & (F.coalesce("prior_velocity", F.lit(0.0)) > 1)).cast("int").alias("sustained"),
        "recent", "previous", "sources",
        F.round(s.velocity_raw(F.col("recent"), F.col("previous")), 6).alias("velocity_raw"),
        F.round(s.velocity_floor(F.col("recent"), F.col("previous")), 6).alias("velocity_floor"),
        "trend_score",
    )


def movers_view(rows: DataFrame, cube: DataFrame, latest: str, p: s.Profile, labels: DataFrame, days: int = 7, shown: int = 50) -> DataFrame:
    """The movers as rows of their contract. labels: entity_id, label, type; an entity without a label has its id for one.

    in_trending_view: among the `shown` first ranks. bridge_delta is null: histories of bridges are a table of their own.
    """
    m = movers(rows, cube, latest, p, days)
    now = rows.where(F.col("run_date") == latest).select("entity_id", "mention_count_7d", "mention_count_30d")
    first = cube.groupBy("entity_id").agg(first_day().alias("first_seen"))
    j = m.join(now, "entity_id").join(first, "entity_id").join(labels, "entity_id", "left")
    return j.select(
        "entity_id", F.coalesce("label", "entity_id").alias("label"), F.coalesce("type", F.lit("Other")).alias("type"), F.col("rank").alias("current_rank"), F.col("prior_rank").alias("rank_prior"), "rank_delta",
        (F.col("is_new") == 1).alias("is_new"), "velocity_raw", F.col("velocity_floor").alias("velocity_ci_lower"), (F.col("sustained") == 1).alias("sustained"), F.lit(None).cast("double").alias("bridge_delta"),
        "mention_count_7d", "mention_count_30d", "first_seen", F.greatest(F.lit(0), F.datediff(F.lit(latest).cast("date"), F.col("first_seen").cast("date"))).alias("days_since_first_seen"),
        F.col("sources").alias("distinct_sources_7d"), (F.col("rank") <= shown).alias("in_trending_view"), "trend_score",
    )


def run_overlap(rows: DataFrame, k: int = 10) -> DataFrame:
    """Shared share of the top k of consecutive runs."""
    top = ranks(rows).where(F.col("rank") <= k).select("run_date", "entity_id")
    dates = rows.select("run_date").distinct()
    pairs = dates.withColumn("prior", F.lag("run_date").over(Window.orderBy("run_date"))).where("prior is not null")  # a row per run
    a = top.join(pairs, "run_date")
    b = top.select(F.col("run_date").alias("prior"), "entity_id", F.lit(1).alias("shared"))
    sizes = top.groupBy("run_date").agg(F.count("*").alias("n"))
    return (
        a.join(b, ["prior", "entity_id"], "left")
        .groupBy("run_date", "prior")
        .agg(F.count("shared").alias("shared"), F.count("*").alias("n"))
        .join(sizes.select(F.col("run_date").alias("prior"), F.col("n").alias("m")), "prior")
        .select("run_date", "prior", "shared", (F.col("shared") / F.greatest("n", "m")).alias("overlap"))
    )
