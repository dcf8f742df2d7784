"""Document selection under a budget, and the bench."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegraph.functions import scoring as s
from tidegraph.sources.shared import materialise

MIN_QUALITY, STRETCH_QUALITY, EXPIRY_DAYS = 0.20, 0.55, 5


def score(docs: DataFrame, as_of: str) -> DataFrame:
    """docs (doc_id, text, title, published_at, tier, signal, source) with the five scores and the combined one."""
    d = docs.withColumn("word_count", s.word_count(F.col("text")))
    age = F.datediff(F.lit(as_of).cast("date"), F.try_to_date(F.substring("published_at", 1, 10), "yyyy-MM-dd"))
    d = (
        d.withColumn("word_count_score", s.word_count_score(F.col("word_count")))
        .withColumn("metadata_score", s.metadata_score(F.col("title"), F.col("published_at")))
        .withColumn("tier_score", s.tier_score(F.col("tier")))
        .withColumn("signal_score", s.signal_score(F.col("signal")))
        .withColumn("recency_score", s.recency_score(age))
    )
    parts = [F.col(f"{x}_score") for x in ("word_count", "metadata", "tier", "signal", "recency")]
    return d.withColumn("combined_score", F.round(s.combined_score(*parts), 6))


def select(scored: DataFrame, budget: int, stretch: int | None = None) -> DataFrame:
    """outcome (selected, benched, rejected) of every scored document.

    Below the least quality documents are rejected. If the rest fits the budget, all are
    selected; else each source's best (up to `stretch` of them), then others by score up to
    the budget, then up to `stretch` those of stretch quality. Ties go to the smaller doc_id.
    Only the first `stretch` places matter, so there is no order over all candidates: the
    best of each source and the best of the rest are distributed top-k queries, and their few
    ids are joined back. Texts are scored once.
    """
    stretch = budget + 5 if stretch is None else stretch
    rows = materialise(scored.select("doc_id", "source", "combined_score"), "scored")
    good = rows.where(F.col("combined_score") >= MIN_QUALITY)
    order = [F.desc("combined_score"), F.col("doc_id")]
    best = good.groupBy("source").agg(F.min(F.struct((-F.col("combined_score")).alias("low"), "doc_id")).alias("m"))
    reps = best.select(F.col("m.doc_id").alias("doc_id"), (-F.col("m.low")).alias("combined_score")).orderBy(*order).limit(stretch).select("doc_id")
    reps = materialise(reps, "reps")
    n, k = good.count(), reps.count()
    if n <= budget:
        chosen = good.select("doc_id")
    else:
        room = max(budget, stretch) - k
        rest = good.join(F.broadcast(reps), "doc_id", "left_anti").orderBy(*order).limit(max(0, room))  # `stretch` ids at most
        place = F.row_number().over(Window.orderBy(*order))
        fill = rest.withColumn("place", place).where((F.col("place") <= budget - k) | ((F.col("place") <= stretch - k) & (F.col("combined_score") >= STRETCH_QUALITY)))
        chosen = reps.union(fill.select("doc_id"))
    outcome = F.when(F.col("combined_score") < MIN_QUALITY, "rejected").when(F.col("in").isNotNull(), "selected").otherwise("benched")
    return rows.join(chosen.select("doc_id", F.lit(1).alias("in")), "doc_id", "left").select("doc_id", "source", "combined_score", outcome.alias("outcome"))


def bench_add(bench: DataFrame, overflow: DataFrame, now: str) -> DataFrame:
    """Insert-ignore of overflow documents, with their expiry."""
    fresh = overflow.select("doc_id", F.col("combined_score").alias("quality_score"), F.lit(now).alias("scored_at"), F.date_format(F.date_add(F.lit(now).cast("date"), EXPIRY_DAYS), "yyyy-MM-dd").alias("expires_at"))
    return bench.unionByName(fresh.join(bench.select("doc_id"), "doc_id", "left_anti"))


def bench_top(bench: DataFrame, documents: DataFrame, now: str, k: int) -> DataFrame:
    """Best unexpired bench documents that still exist."""
    live = bench.where(F.col("expires_at") > now).join(documents, "doc_id")
    return live.orderBy(F.desc("quality_score"), "doc_id").limit(k)
