"""Lines that the stages of a daily run print, as rows of numbers: one pass over text with a table of patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ITEM = r"^\s*-\s*(\d+)\s+"
# What stages print, and the names of the numbers. (stage, name, how, pattern): the group of the pattern is the
# number; how: sum of all lines, last line, count of lines that fit, or most (a summary, which raises what the others give).
PATTERNS = [
    ("ingest", "feedsChecked", "count", r"(?i)^\s*(?:\[\d+/\d+\]\s*)?processing(?: feed)?:"), ("ingest", "feedsReachable", "count", r"(?i)feed ok|feed errors:"), ("ingest", "feedsReachable", "most", r"(?i)feeds reachable:\s*(\d+)/"),
    ("ingest", "feedsUnreachable", "count", r"(?i)feed (?:unreachable|crashed)"), ("ingest", "newDocsFound", "sum", r"(?i)feed (?:ok|errors):.*?(\d+) (?:new documents|saved)"), ("ingest", "duplicatesSkipped", "sum", r"(?i)feed (?:ok|errors):.*?(\d+) duplicates skipped"),
    ("ingest", "fetchErrors", "sum", r"(?i)feed errors:\s*(\d+) fetch errors"), ("ingest", "fetchErrors", "count", r"(?i)feed crashed"), ("ingest", "fetchErrors", "most", r"(?i)errors\s+(\d+).*feeds reachable:"),
    ("docpack", "docsBundled", "last", r"(?i)^(?=.*bundled).*?(?<!\S)(\d+)(?!\S)"), ("docpack", "qualifiedTotal", "last", r"^Qualified:.*?(\d+) total"), ("docpack", "qualifiedExcluded", "last", r"^Qualified:.*?(\d+) excluded"),
    ("extract", "docsExtracted", "last", r"^Done\..*?Succeeded\D*(\d+)"), ("extract", "validationErrors", "last", r"^Done\..*?Failed\D*(\d+)"), ("extract", "escalated", "last", r"^Done\..*?Escalated\D*(\d+)"),
    ("extract", "entitiesFound", "sum", r"\((?:[^()]*?\D)?(\d+) entit[^()]*relations?[^()]*\)\s*$"), ("extract", "relationsFound", "sum", r"entities.*?(\d+) relations?[^()]*\)\s*$"),
    ("import", "filesImported", "last", r"(?i)^(?=.*imported)(?=.*extraction).*?(?<!\S)(\d+)(?!\S)"), ("import", "entitiesNew", "last", r"(?i)(\d+)\s+new"), ("import", "entitiesResolved", "last", r"(?i)(\d+)\s+resolved"),
    ("import", "relations", "last", _ITEM + "relations"), ("import", "mentionsGenerated", "last", _ITEM + "mentions"), ("import", "evidenceRecords", "last", _ITEM + "evidence"),
    ("export", "totalNodes", "sum", r"\(?(\d+) nodes.*edges"), ("export", "totalEdges", "sum", r"nodes.*?(\d+) edges"), ("movers", "moversRows", "last", r"(\d+)\s+rows\s+\(window:"), ("movers", "moversWindowDays", "last", r"rows\s+\(window:\s+(\d+)\s+days\)"),
    ("trending", "trendingNodes", "last", r"(\d+) nodes.*edges"), ("trending", "trendingEdges", "last", r"nodes.*?(\d+) edges"), ("trending", "narrativesGenerated", "last", r"(?i)generated narratives\D*(\d+)"), ("trending", "narrativesLlmReturned", "last", r"(?i)(\d+) llm narratives returned"),
    ("trending", "narrativesMapped", "last", r"(?i)(\d+) narratives mapped"), ("trending", "narrativesMismatches", "last", r"(?i)(\d+) name mismatches dropped"), ("trending", "narrativesContextSkipped", "last", r"(?i)(\d+) narrative context skipped"),
    ("synthesize", "batchesProcessed", "last", r"(?i)(\d+) (?:document )?clusters processed"), ("synthesize", "entitiesCorroborated", "last", r"(?i)(\d+) entities corroborated"), ("synthesize", "relationsInferred", "last", r"(?i)(\d+) relations inferred"),
    ("synthesize", "llmCalls", "last", r"(?i)(\d+) llm calls"), ("synthesize", "durationMs", "last", r"^\s*-\s*(\d+)ms\s*$"), ("resolve", "entitiesChecked", "last", r"(?i)(\d+) entities checked"), ("resolve", "mergesPerformed", "last", r"(?i)(\d+) merges performed"),
    ("resolve", "disambigPairsEvaluated", "last", r"(?i)(\d+) (?:gray-zone )?pairs evaluated"), ("resolve", "disambigMerges", "last", r"(?i)(\d+) (?:llm-)?confirmed merges"), ("resolve", "disambigKeptSeparate", "last", r"(?i)(\d+) kept separate"),
    ("resolve", "disambigUncertain", "last", r"(?i)(\d+) uncertain"), ("infer", "rulesEvaluated", "last", r"(?i)(\d+) rules evaluated"), ("infer", "relationsInferred", "last", r"(?i)(\d+) relations inferred"), ("infer", "relationsSkipped", "last", r"(?i)(\d+) skipped"), ("infer", "durationMs", "last", r"^\s*-\s*(\d+)ms\s*$"),
]
#: Stages of the funnel of documents, with the number that tells how far they came.
FUNNEL = [("ingest", "newDocsFound"), ("docpack", "docsBundled"), ("extract", "docsExtracted"), ("import", "filesImported")]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(run_date, stage, line, place) of log files in folders run_date=<day>/stage=<name>, one file a stage; place keeps their order."""
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return spark.read.schema("value string, run_date string, stage string").text(path).select("run_date", "stage", F.col("value").alias("line"), at.alias("place"))


def numbers(lines: DataFrame, patterns: list[tuple] = PATTERNS) -> DataFrame:
    """(run_date, stage, name, value) of lines (run_date, stage, line, place): all numbers of each stage that a run has lines of, 0 if none fits.

    Each line meets the patterns of its own stage only; the lines are read once, and what leaves
    a task is one partial number for each name. Stages without patterns give none, null lines fit nothing.
    """
    def fits(name, how, pattern):
        hit = F.col("line").rlike(pattern)
        value = F.lit(1).cast("long") if how == "count" else F.regexp_extract("line", pattern, 1).try_cast("long")
        return F.struct(F.lit(name).alias("name"), F.lit(how).alias("how"), F.when(hit, value).alias("value"))

    found = None
    for stage in dict.fromkeys(s for s, *_ in patterns):
        own = F.array(*(fits(*p) for s, *p in patterns if s == stage))
        found = F.when(F.col("stage") == stage, own) if found is None else found.when(F.col("stage") == stage, own)
    x = lines.select("run_date", "stage", "place", F.explode(found).alias("f")).select("run_date", "stage", "place", "f.*")
    is_ = lambda *how: F.col("how").isin(*how)
    added = F.coalesce(F.sum(F.when(is_("sum", "count"), F.col("value"))), F.lit(0))
    last = F.max(F.when(is_("last") & F.col("value").isNotNull(), F.struct("place", "value")))["value"]
    most = F.coalesce(F.max(F.when(is_("most"), F.col("value"))), F.lit(0))
    return x.groupBy("run_date", "stage", "name").agg(F.coalesce(last, F.greatest(added, most)).alias("value"))


def funnel(found: DataFrame) -> DataFrame:
    """(run_date, stage, place, docs, kept): how many documents of a run came to each stage, and their share of the first one's; stages without lines are left out."""
    names = F.array(*(F.struct(F.lit(i).alias("place"), F.lit(s).alias("stage"), F.lit(n).alias("name")) for i, (s, n) in enumerate(FUNNEL)))
    of = found.withColumn("f", F.try_element_at(F.filter(names, lambda f: (f["stage"] == F.col("stage")) & (f["name"] == F.col("name"))), F.lit(1)))
    of = of.where("f is not null").select("run_date", "stage", "f.place", F.col("value").alias("docs"))
    start = of.where("place = 0").select("run_date", F.col("docs").alias("all"))
    return of.join(start, "run_date", "left").select("run_date", "stage", "place", "docs", F.when(F.col("all") > 0, F.round(F.col("docs") / F.col("all"), 6)).alias("kept"))
