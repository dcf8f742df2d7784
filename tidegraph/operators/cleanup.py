"""Cleaning of extraction answers, lookups of names, summaries of document clusters, coverage counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegraph.functions import pages
from tidegraph.functions.text import name_similarity, normalize_name
from tidegraph.operators.resolve import candidates

#: Date resolutions as models write them, and the three that are stored.
RESOLUTIONS = {
    "exact": ("day", "daily", "month", "year"),
    "range": ("weekly", "week", "season", "decade", "duration", "period", "quarterly", "annual"),
    "unknown": ("approximate",),
}


def resolution(value: Column) -> Column:
    """The stored form of a date's resolution; unlisted values and nulls stay as they are."""
    out = value
    for stored, written in RESOLUTIONS.items():
        out = F.when(value.isin(*written), F.lit(stored)).otherwise(out)
    return out


def canonical_type(value: Column, types: list[str]) -> Column:
    """The listed type that equals the value but for case; other values stay."""
    return F.coalesce(*(F.when(F.lower(value) == t.lower(), F.lit(t)) for t in types), value)


def age_hours(stamp: Column, now: str) -> Column:
    """Hours from the stamp to now, as a double; null for null."""
    zone = lambda c: c.cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", zone(stamp), zone(F.lit(now))) / 3600.0


def lookup(wanted: DataFrame, names: DataFrame, aliases: DataFrame, low: float = 0.8) -> DataFrame:
    """(query, type, id, similarity): entities that a name may mean.

    wanted: query, type. names: id, type, name. aliases: alias, id (one per alias). An alias
    that equals the query ends its search with similarity 1; otherwise every name of the type
    with at least `low` counts. Null queries find nothing. Candidates share a rare key, so no name
    is compared with all others.
    """
    q = wanted.where("query is not null").select("query", "type").distinct()
    exact = q.join(aliases.select(F.col("alias").alias("query"), "id"), "query").select("query", "type", "id", F.lit(1.0).alias("similarity"))
    rest = q.join(aliases.select(F.col("alias").alias("query")), "query", "left_anti").withColumn("name", normalize_name(F.col("query")))
    n = names.select("id", "type", normalize_name(F.col("name")).alias("name"))
    pairs = candidates(rest.select("type", "name").distinct(), n.select("type", "name").distinct(), low)
    good = pairs.withColumn("similarity", name_similarity(F.col("n1"), F.col("n2"))).where(F.col("similarity") >= low)
    near = good.join(rest.withColumnRenamed("name", "n1"), ["type", "n1"]).join(n.withColumnRenamed("name", "n2"), ["type", "n2"])
    return exact.union(near.select("query", "type", "id", "similarity"))


def shared_entities(members: DataFrame, mentions: DataFrame, least: int = 2, cap: int = 30) -> DataFrame:
    """(cluster, entity_id, docs_mentioning): the first `cap` entities, by id, that at least `least` documents of a cluster mention.

    members: cluster, doc_id. mentions: doc_id, entity_id. Counts are merged before the ranking, which needs one row per entity only.
    """
    n = members.join(mentions.select("doc_id", "entity_id").distinct(), "doc_id").groupBy("cluster", "entity_id").agg(F.count("*").alias("docs_mentioning"))
    w = Window.partitionBy("cluster").orderBy("entity_id")
    return n.where(F.col("docs_mentioning") >= least).withColumn("n", F.row_number().over(w)).where(F.col("n") <= cap).drop("n")


def inner_edges(shared: DataFrame, relations: DataFrame, cap: int = 50) -> DataFrame:
    """(cluster, relation_id, source_id, rel, target_id): the first `cap` relations between entities of one cluster."""
    s = shared.select("cluster", F.col("entity_id").alias("source_id"))
    o = shared.select("cluster", F.col("entity_id").alias("target_id"))
    found = relations.where("rel <> 'MENTIONS'").join(s, "source_id").join(o, ["cluster", "target_id"])
    w = Window.partitionBy("cluster").orderBy("relation_id")
    return found.withColumn("n", F.row_number().over(w)).where(F.col("n") <= cap).select("cluster", "relation_id", "source_id", "rel", "target_id")


def light_day_backfill(chosen: DataFrame, bench: DataFrame, slots: int) -> DataFrame:
    """The best `slots` bench rows (doc_id, quality_score), ties by doc_id, less those chosen already."""
    return bench.orderBy(F.desc("quality_score"), "doc_id").limit(slots).join(chosen.select("doc_id"), "doc_id", "left_anti")


def promotion(runs: DataFrame, valid: float = 0.95, entities: float = 0.85, relations: float = 0.8, docs: int = 100) -> DataFrame:
    """Per model (schema_valid, entity_pct, relation_pct): means and whether all four thresholds hold; a null mean fails."""
    m = runs.groupBy("model").agg(F.count("*").alias("docs"), F.avg("schema_valid").alias("valid_rate"), F.avg("entity_pct").alias("entity_pct"), F.avg("relation_pct").alias("relation_pct"))
    ok = (F.col("valid_rate") >= valid) & (F.col("entity_pct") >= entities) & (F.col("relation_pct") >= relations) & (F.col("docs") >= docs)
    return m.withColumn("promotable", F.coalesce(ok, F.lit(False)).cast("int"))


def repair(documents: DataFrame) -> DataFrame:
    """documents (status, text, html and more) with lost texts read again from their pages, and what was done.

    Of documents in status cleaned whose text is null: `recovered`, where there is a page, with
    its text and a new content_hash; else `lost`, which sets status and error. All others are
    `kept` as they are, with a null error and the hash of their text.
    """
    need = (F.coalesce(F.col("status"), F.lit("")) == "cleaned") & F.col("text").isNull()
    page = pages.cleaned(documents.withColumn("_again", F.when(need, F.col("html"))), "_again")
    done = F.when(need & F.col("html").isNull(), "lost").when(need, "recovered").otherwise("kept")
    text = F.when(F.col("done") == "recovered", F.col("page.text")).otherwise(F.col("text"))
    return (
        page.withColumn("done", done).withColumn("text", text).withColumn("content_hash", F.sha2("text", 256))
        .withColumn("status", F.when(F.col("done") == "lost", "error").otherwise(F.col("status")))
        .withColumn("error", F.when(F.col("done") == "lost", "data_loss: both raw and text missing")).drop("_again", "page")
    )
