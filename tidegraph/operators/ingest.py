"""Feeds, posts and filings as documents. Inputs are tables or files; nothing is fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.functions.text import document_id, slugify

FUTURE_DAYS = 2


def entry_date(stamp: Column, as_of: str) -> Column:
    """The day of an RFC-822 stamp in its own zone; null if unreadable or more than two days ahead."""
    parts = r"^\s*(?:[A-Za-z]{3}\s*,\s*)?([0-9]{1,2})\s+([A-Za-z]{3})[a-z]*\s+([0-9]{4})\s.*$"
    plain = F.regexp_replace(stamp, parts, "$1 $2 $3")
    day = F.try_to_date(F.when(stamp.rlike(parts), plain), "d MMM yyyy")
    return F.when(day <= F.date_add(F.lit(as_of).cast("date"), FUTURE_DAYS), F.date_format(day, "yyyy-MM-dd"))


def in_scope(text: Column, include: list[str], exclude: list[str]) -> Column:
    """Any of `include` (all, if empty) and none of `exclude`, regardless of case; exclusion wins."""
    low = F.lower(F.coalesce(text, F.lit("")))
    has = lambda words: F.exists(F.array(*(F.lit(w.lower()) for w in words)), lambda w: low.contains(w))
    out = has(include) if include else F.lit(True)
    return out & ~has(exclude) if exclude else out


def read_feed(spark: SparkSession, path: str, row: str = "item") -> DataFrame:
    """Entries of feed files (title, link, published, summary). row: `item`, or `entry` of the other format."""
    schema = "title string, link string, pubDate string, published string, updated string, description string, summary string, id string"
    x = spark.read.format("xml").option("rowTag", row).schema(schema).load(path)
    return x.select(
        F.trim("title").alias("title"), F.coalesce("link", "id").alias("link"), F.coalesce("pubDate", "published", "updated").alias("published"),
        F.coalesce("description", "summary").alias("summary"),
    )


def feed_documents(entries: DataFrame, source: str, as_of: str, include=(), exclude=(), max_age: int | None = None, cap: int | None = None) -> DataFrame:
    """Entries in scope and not older than max_age days as documents, one per link; `cap` is the feed's own limit."""
    d = entries.where(in_scope(F.concat_ws(" ", "title", "summary"), list(include), list(exclude))).where("link is not null")
    d = d.withColumn("published_at", entry_date(F.col("published"), as_of))
    if max_age is not None:
        d = d.where(F.col("published_at").isNull() | (F.datediff(F.lit(as_of).cast("date"), F.col("published_at").cast("date")) <= max_age))
    one = d.groupBy("link").agg(F.min(F.struct("published_at", "title", "summary")).alias("e")).select("link", "e.*")
    out = one.select(
        document_id(F.coalesce("published_at", F.lit(as_of)), F.lit(source), F.col("link")).alias("doc_id"),
        F.col("link").alias("url"), F.lit(source).alias("source"), "title", "published_at", F.col("summary").alias("text"),
    )
    return out if cap is None else out.orderBy(F.desc_nulls_last("published_at"), "doc_id").limit(cap)


def social_documents(posts: DataFrame, source: str) -> DataFrame:
    """posts (uri, handle, text, created_at) as documents; the title is the first line, up to 120 characters."""
    key = F.element_at(F.split("uri", "/"), -1)
    did = F.when(F.col("uri").contains("://"), F.substring(F.element_at(F.split(F.try_element_at(F.split("uri", "/"), F.lit(3)), ":"), -1), 1, 12)).otherwise("unknown")
    handle, text = F.coalesce("handle", F.lit("unknown")), F.coalesce("text", F.lit(""))
    line = F.when(text == "", "(no text)").otherwise(F.substring(F.substring_index(text, "\n", 1), 1, 120))
    return posts.select(
        F.concat(F.lit("bsky_"), did, F.lit("_"), key).alias("doc_id"),
        F.concat(F.lit("https://bsky.app/profile/"), handle, F.lit("/post/"), key).alias("url"),
        F.lit(source).alias("source"), F.concat(F.lit("@"), handle, F.lit(": "), line).alias("title"), text.alias("text"),
        F.date_format(F.try_to_date(F.substring("created_at", 1, 10), "yyyy-MM-dd"), "yyyy-MM-dd").alias("published_at"),
        F.when(text != "", F.sha2(text, 256)).alias("content_hash"),
    )


def listing_documents(posts: DataFrame, source: str) -> DataFrame:
    """posts (id, group, title, body, is_self, url, permalink, created_utc) as documents."""
    head = F.coalesce("title", F.lit("(no title)"))
    body = F.coalesce("body", F.lit(""))
    text = (
        F.when(~F.col("is_self"), F.concat(head, F.lit("\n\n[Link: "), F.coalesce("url", F.lit("")), F.lit("]")))
        .when(body != "", F.concat(head, F.lit("\n\n"), body))
        .otherwise(head)
    )
    return posts.select(
        F.concat(F.lit("reddit_"), F.col("group"), F.lit("_"), "id").alias("doc_id"),
        F.when(F.coalesce("permalink", F.lit("")) != "", F.concat(F.lit("https://www.reddit.com"), "permalink")).otherwise(F.col("url")).alias("url"),
        F.lit(source).alias("source"), F.concat(F.lit("r/"), F.col("group"), F.lit(": "), F.substring(head, 1, 100)).alias("title"), text.alias("text"),
        F.when(F.col("created_utc") != 0, F.date_format(F.timestamp_seconds("created_utc"), "yyyy-MM-dd")).alias("published_at"),
        F.sha2(text, 256).alias("content_hash"),
    )


def filer_number(c: Column) -> Column:
    """Digits only, with zeros in front up to ten."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    return F.when(F.length(digits) < 10, F.lpad(digits, 10, "0")).otherwise(digits)


def unmapped_types(errors: DataFrame) -> DataFrame:
    """How often each unmapped type occurs in error texts (error)."""
    name = F.regexp_extract("error", "'([A-Z_]+)' is not one of", 1)
    return errors.select(name.alias("name")).where("name <> ''").groupBy("name").agg(F.count("*").alias("n"))


def trajectory(documents: int, entities: int, days: int, goal: int = 500) -> dict:
    """Days until `goal` entities at the present rate; 0 when reached, None without a rate."""
    if documents <= 0 or days <= 0:
        return {"per_doc": None, "days_to_goal": None}
    per_doc = entities / documents if entities else 8.0
    return {"per_doc": per_doc, "days_to_goal": max(0.0, (goal - entities) / (documents / days * per_doc))}


__all__ = ["entry_date", "feed_documents", "filer_number", "in_scope", "listing_documents", "read_feed", "slugify", "social_documents", "trajectory", "unmapped_types"]
