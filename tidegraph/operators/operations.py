"""Running the graph day by day: alerts, suggestions, budgets, batch jobs, run logs, model comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegraph.operators import extraction

# The rules of a calibration report. A measure above (or below) a limit raises the
# signal with that severity; of several rules of one signal the most severe speaks.
RULES = [
    ("yield_drop", "entity_yield_drop", "above", 0.30, "WARN"),
    ("orphan_edges", "orphan_edges", "above", 500.0, "CRITICAL"),
    ("orphan_edges", "orphan_edges", "above", 100.0, "WARN"),
    ("orphan_edges", "orphan_edges", "above", 0.0, "INFO"),
    ("error_streak", "feed_error_streak", "from", 7.0, "CRITICAL"),
    ("error_streak", "feed_error_streak", "from", 3.0, "WARN"),
    ("bench_ratio", "high_bench_ratio", "above", 0.92, "INFO"),
    ("batch_latency", "batch_latency", "above", 6.0, "INFO"),
    ("source_yield_drop", "low_yield_source", "above", 0.50, "INFO"),
    ("gated_share", "velocity_gate_saturation", "above", 0.80, "WARN"),
    ("novelty_below", "novelty_compressed_low", "above", 0.90, "WARN"),
    ("novelty_above", "novelty_compressed_high", "above", 0.90, "WARN"),
    ("top_overlap", "trending_churn_unstable", "below", 0.10, "WARN"),
    ("top_overlap", "trending_churn_stale", "above", 0.70, "INFO"),
]
SEVERITIES = ("CRITICAL", "WARN", "INFO")


def suggestions(measures: DataFrame, rules: list[tuple] = RULES) -> DataFrame:
    """(subject, signal, severity, value, place) of every measure (measure, subject, value) that breaks a rule.

    place orders the severities (0 is the worst). Null values break no rule; a measure
    without a rule is ignored; equal rows count once.
    """
    spark = measures.sparkSession
    r = spark.createDataFrame(rules, "measure string, signal string, side string, bound double, severity string")
    v, b = F.col("value"), F.col("bound")
    broken = F.when(F.col("side") == "above", v > b).when(F.col("side") == "from", v >= b).otherwise(v < b)
    place = F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col("severity")).cast("int") - 1
    hits = measures.join(F.broadcast(r), "measure").where(broken)  # a row per rule
    worst = hits.groupBy("subject", "signal", "value").agg(F.min(F.struct(place.alias("place"), "severity")).alias("m"))
    return worst.select("subject", "signal", F.col("m.severity").alias("severity"), "value", F.col("m.place").alias("place"))


def _hours(stamp: Column, now: str) -> Column:
    seconds = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(stamp.try_cast("timestamp"))
    return F.round(seconds / 3600, 6)


def staleness(domains: DataFrame, feeds: DataFrame, now: str, hours: float, feed_days: float) -> DataFrame:
    """(key, age, last) of everything that has been silent for too long.

    domains (domain, last_doc, last_run) raise `domain:<name>:docs` and `domain:<name>:trend`;
    a missing or unreadable stamp is an alert with a null age. feeds (domain, feed, enabled,
    last) raise `feed:<domain>/<name>`, unless their domain already lacks documents; disabled
    feeds and those that never delivered raise none.
    """
    both = domains.select(
        "domain",
        F.explode(F.array(F.struct(F.lit("docs").alias("part"), F.col("last_doc").alias("last")), F.struct(F.lit("trend").alias("part"), F.col("last_run").alias("last")))).alias("s"),
    ).select("domain", "s.*").withColumn("age", _hours(F.col("last"), now))
    late = both.where((F.col("age") > hours) | F.col("age").isNull())
    stalled = late.where("part = 'docs'").select("domain")
    silent = feeds.where("enabled").withColumn("age", _hours(F.col("last"), now)).where(F.col("age") > feed_days * 24)
    of_feeds = silent.join(stalled, "domain", "left_anti").select(F.concat(F.lit("feed:"), "domain", F.lit("/"), "feed").alias("key"), "age", "last")
    return late.select(F.concat(F.lit("domain:"), "domain", F.lit(":"), "part").alias("key"), "age", "last").union(of_feeds)


def page(alerts: DataFrame, state: DataFrame, now: str, again_hours: float) -> tuple[DataFrame, DataFrame]:
    """(alerts with `due`, the next state): a key is paged when new, and again after `again_hours`.

    state (key, paged_at) has one row per key; keys that no longer alert leave it, so a
    return is paged at once.
    """
    j = alerts.join(state.select("key", "paged_at"), "key", "left")
    since = _hours(F.col("paged_at"), now)
    j = j.withColumn("due", F.coalesce(since >= again_hours, F.lit(True)).cast("int"))
    after = j.select("key", F.when(F.col("due") == 1, now).otherwise(F.col("paged_at")).alias("paged_at"))
    return j.drop("paged_at"), after


def budgets(profiles: DataFrame, budget: int = 20, stretch: int = 25, step: int = 5) -> DataFrame:
    """profiles (domain, budget, stretch; either may be null) with their defaults filled in.

    A budget alone stretches by `step`; without a budget both defaults hold, but a stretch of its own stays.
    """
    return profiles.select(
        "domain", F.coalesce("budget", F.lit(budget)).alias("budget"),
        F.coalesce("stretch", F.when(F.col("budget").isNotNull(), F.col("budget") + step).otherwise(stretch)).alias("stretch"),
    )


def submit(jobs: DataFrame, candidates: DataFrame, extracted: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """(job rows, job documents) of a day's submission.

    One job per domain and day from candidates (domain, run_date, doc_id): documents already
    extracted are left out, and so are domains and days with a pending job in `jobs`. The
    documents of a job are rows (job_id, doc_id), not a list in the job.
    """
    busy = jobs.where("status = 'pending'").select("domain", "run_date")
    todo = candidates.select("domain", "run_date", "doc_id").distinct()
    todo = todo.join(busy, ["domain", "run_date"], "left_anti").join(extracted.select("doc_id"), "doc_id", "left_anti")
    todo = todo.withColumn("job_id", F.concat_ws("_", "domain", "run_date"))
    rows = todo.groupBy("job_id", "domain", "run_date").agg(F.count("*").alias("docs"))
    rows = rows.select("job_id", "domain", "run_date", F.lit(now).alias("submitted_at"), F.lit("pending").alias("status"), "docs")
    return rows, todo.select("job_id", "doc_id")


def collect(jobs: DataFrame, documents: DataFrame, results: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """(jobs, outcomes) once results (job_id, doc_id, type, answer) have come in.

    A pending job with any result is complete; others stay as they are. Every document of a
    job completed now has an outcome: `succeeded` with its answer, else `fallback`, to be
    asked again one by one. Of several results of a document a succeeded one wins, then the smallest answer.
    """
    ended = results.select("job_id").distinct().withColumn("ended", F.lit(True))
    j = jobs.join(ended, "job_id", "left").withColumn("now", (F.col("status") == "pending") & F.coalesce("ended", F.lit(False)))
    good = results.where("type = 'succeeded'").groupBy("job_id", "doc_id").agg(F.min("answer").alias("answer"))
    done = documents.join(j.where("now").select("job_id"), "job_id", "left_semi").distinct().join(good.withColumn("ok", F.lit(1)), ["job_id", "doc_id"], "left")
    outcomes = done.select("job_id", "doc_id", F.when(F.col("ok") == 1, "succeeded").otherwise("fallback").alias("outcome"), "answer")
    after = j.withColumn("status", F.when(F.col("now"), "complete").otherwise(F.col("status"))).withColumn("completed_at", F.when(F.col("now"), F.lit(now)))
    return after.drop("ended", "now"), outcomes


#: The parts of a run log that reports read; numbers are missing where a stage did not run.
LOG = (
    "struct<runDate: string, domain: string, status: string, durationSec: double, stages: struct<"
    "ingest: struct<newDocsFound: long, feedsChecked: long, feedsReachable: long>, docpack: struct<docsBundled: long>, "
    "extract: struct<docsExtracted: long, entitiesFound: long, relationsFound: long>, "
    "`import`: struct<entitiesNew: long, relations: long>, export: struct<totalNodes: long, totalEdges: long>>>"
)


def read_logs(spark: SparkSession, path: str, last: int = 30) -> DataFrame:
    """(file, x) of the last readable run logs of a folder, by file name, newest first."""
    from tidegraph.sources.files import read_documents

    good, _ = read_documents(spark, path, LOG)
    return good.orderBy(F.desc("file")).limit(last)


def runs(logs: DataFrame) -> DataFrame:
    """A row per run log (x): counts with their fallbacks, and the backlog of bundled documents not extracted.

    Zero or missing entities and relations of extraction fall back to those of the import; a
    run without either stage of documents has a null backlog; a missing status is `unknown`.
    """
    x = lambda p: F.col(f"x.{p}")
    found = lambda a, b: F.coalesce(F.nullif(x(a), F.lit(0)), x(b))
    bundled, extracted = (F.coalesce(x(p), F.lit(0)) for p in ("stages.docpack.docsBundled", "stages.extract.docsExtracted"))
    return logs.select(
        x("runDate").alias("run_date"), x("domain").alias("domain"), F.coalesce(x("status"), F.lit("unknown")).alias("status"), x("durationSec").alias("duration"),
        F.coalesce(x("stages.ingest.newDocsFound"), F.lit(0)).alias("new_docs"), bundled.alias("bundled"),
        found("stages.extract.entitiesFound", "stages.import.entitiesNew").alias("entities"),
        found("stages.extract.relationsFound", "stages.import.relations").alias("relations"),
        x("stages.export.totalNodes").alias("nodes"), x("stages.export.totalEdges").alias("edges"),
        F.when((bundled != 0) | (extracted != 0), F.greatest(F.lit(0), bundled - extracted)).alias("backlog"),
    )


def status(logs: DataFrame, view_nodes: Column, view_edges: Column) -> DataFrame:
    """The row of the newest run; missing graph sizes fall back to those of the live view. No logs give no row."""
    newest = runs(logs).orderBy(F.desc("run_date"), "domain").limit(1)
    return newest.withColumn("edges", F.coalesce("edges", F.when(F.col("nodes").isNull(), view_edges))).withColumn("nodes", F.coalesce("nodes", view_nodes))


def compare_models(answers: DataFrame) -> DataFrame:
    """Per model: answers, and the shares that parse, and that hold to the schema, of answers (doc_id, model, answer)."""
    # the model goes along with the answer, which is read once
    j = extraction.validate(extraction.parse(answers.select("doc_id", "model", "answer")), "model", F.col("x").isNotNull().cast("int").alias("read"))
    ok = (F.col("read") == 1) & (F.size("errors") == 0)
    return j.groupBy("model").agg(
        F.count("*").alias("answers"), F.round(F.avg("read"), 6).alias("parse_rate"), F.round(F.count_if(ok) / F.count("*"), 6).alias("schema_rate")
    )


def with_snapshot(history: DataFrame, epoch: Column, methodology: str, decay: float, min_mentions: int) -> DataFrame:
    """Rows of trend history with the settings that made them, their epoch, and the entities of their run."""
    n = history.groupBy("run_date").agg(F.count("*").alias("corpus_entity_count"))
    return history.join(n, "run_date").select(
        *history.columns, F.lit(decay).alias("novelty_decay"), F.lit(min_mentions).alias("min_mentions"), "corpus_entity_count",
        epoch.alias("epoch"), F.lit(methodology).alias("methodology_version"),
    )


def prior_runs(history: DataFrame, days: int = 7) -> DataFrame:
    """(run_date, epoch, prior) for every run: the last run of its epoch at least `days` before; null if there is none."""
    own = history.select("run_date", "epoch").distinct()  # a row per run
    at = F.datediff(F.col("run_date").cast("date"), F.lit("1970-01-01").cast("date"))
    before = Window.partitionBy("epoch").orderBy(at).rangeBetween(Window.unboundedPreceding, -days)
    return own.withColumn("prior", F.max("run_date").over(before))


def changes(history: DataFrame, days: int = 7) -> DataFrame:
    """Per entity and run: changes of score and bridge score since the prior run of the epoch, and whether both rose.

    An entity that the prior run lacks is new and has null changes, and so has every entity
    of a run without a prior one. Epochs never meet.
    """
    was = history.select(
        F.col("run_date").alias("prior"), "entity_id", "epoch", F.lit(1).alias("seen"),
        *(F.col(c).alias(f"p_{c}") for c in ("velocity", "trend_score", "bridge_score")),
    )
    j = history.join(prior_runs(history, days), ["run_date", "epoch"]).join(was, ["entity_id", "epoch", "prior"], "left")
    return j.select(
        "entity_id", "run_date", "epoch", "prior", F.col("seen").isNull().cast("int").alias("is_new"),
        F.round(F.col("trend_score") - F.col("p_trend_score"), 6).alias("score_delta"), F.round(F.col("bridge_score") - F.col("p_bridge_score"), 6).alias("bridge_delta"),
        F.coalesce((F.col("velocity") > 1) & (F.col("p_velocity") > 1), F.lit(False)).cast("int").alias("sustained"),
    )
