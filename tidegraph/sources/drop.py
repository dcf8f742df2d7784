"""Feeds and posts from paged drop folders: a Spark data source, batch and stream, and runs over it with their statistics."""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidegraph.functions.text import document_id
from tidegraph.operators.ingest import entry_date, in_scope

SCHEMA = "feed string, page int, place int, kind string, link string, title string, author string, published string, body string, error string"
_FOLDER = re.compile(r"/feed=([^/]+)/page=(\d+)/[^/_.][^/]*$")


@dataclass
class Pages(InputPartition):
    """Files of one feed, by page."""

    feed: str
    files: tuple[tuple[int, str], ...]


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def listed(path: str) -> dict[str, list[tuple[int, str]]]:
    """The pages of each feed, in order: (page, file). Folders are feed=<name>/page=<number>, as partitioned writers make them."""
    store, top = _store(path)
    found: dict[str, list[tuple[int, str]]] = {}
    for info in store.get_file_info(fs.FileSelector(top, allow_not_found=True, recursive=True)):
        m = _FOLDER.search(info.path)
        if m and info.type == fs.FileType.File:
            found.setdefault(m[1], []).append((int(m[2]), info.path))
    return {feed: sorted(pages) for feed, pages in sorted(found.items())}


def _text(node: ET.Element, *names: str) -> str | None:
    """The text of the first child, by its name without name space, that has one."""
    for name in names:
        for child in node:
            if child.tag.rpartition("}")[2] == name:
                said = (child.text or child.get("href") or "").strip()
                if said:
                    return said
    return None


def entries(content: bytes) -> Iterator[tuple]:
    """(kind, link, title, author, published, body) of a page: a JSON object with posts, or a feed in either XML format."""
    if content.lstrip()[:1] == b"{":
        for post in json.loads(content)["posts"]:
            record, author = post.get("record") or {}, post.get("author") or {}
            yield "post", post.get("uri"), None, author.get("handle"), record.get("createdAt"), record.get("text")
        return
    for node in ET.fromstring(content).iter():
        if node.tag.rpartition("}")[2] in ("item", "entry"):
            yield "entry", _text(node, "link"), _text(node, "title"), _text(node, "author", "creator"), _text(node, "pubDate", "published", "updated"), _text(node, "description", "summary")


def rows(path: str, partition: Pages | None) -> Iterator[tuple]:
    """The rows of some pages (an empty folder has a partition None). A page that can't be read is one row with its error, in place of all its entries."""
    store, _ = _store(path)
    for page, file in partition.files if partition else ():
        try:
            with store.open_input_stream(file) as f:
                made = [(partition.feed, page, i, *e, None) for i, e in enumerate(entries(f.read()))]
        except (OSError, ValueError, KeyError, TypeError, AttributeError, ET.ParseError) as e:
            made = [(partition.feed, page, 0, None, None, None, None, None, None, type(e).__name__)]
        yield from made


class _Batch(DataSourceReader):
    def __init__(self, path: str, many: int):
        self.path, self.many = path, many

    def partitions(self):
        return [Pages(feed, tuple(pages[i : i + self.many])) for feed, pages in listed(self.path).items() for i in range(0, len(pages), self.many)]

    def read(self, partition):
        return rows(self.path, partition)


class _Stream(DataSourceStreamReader):
    """Offsets hold, for each feed, the last page up to which none is missing: a page that comes late is never passed over."""

    def __init__(self, path: str, many: int):
        self.path, self.many = path, many

    def initialOffset(self):  # noqa: N802
        return {}

    def latestOffset(self):  # noqa: N802
        out = {}
        for feed, pages in listed(self.path).items():
            numbers, last = {n for n, _ in pages}, 0
            while last + 1 in numbers:
                last += 1
            if last:
                out[feed] = last
        return out

    def partitions(self, start, end):
        out = []
        for feed, pages in listed(self.path).items():
            new = [(n, f) for n, f in pages if start.get(feed, 0) < n <= end.get(feed, 0)]
            out += [Pages(feed, tuple(new[i : i + self.many])) for i in range(0, len(new), self.many)]
        return out

    def read(self, partition):
        return rows(self.path, partition)


class DropFolder(DataSource):
    """spark.read.format("drop_folder").option("path", ...), and readStream likewise.

    Pages of a feed, `pagesPerTask` (16) at a time, are the partitions; each task reads its own
    files, from any store that Arrow opens. The same folder gives the same rows, and a stream the
    same rows for the same offsets, as pages don't change once they are there.
    """

    @classmethod
    def name(cls):
        return "drop_folder"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Batch(self.options["path"], int(self.options.get("pagesPerTask", 16)))

    def streamReader(self, schema):  # noqa: N802
        return _Stream(self.options["path"], int(self.options.get("pagesPerTask", 16)))


def read(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    spark.dataSource.register(DropFolder)
    return (spark.readStream if stream else spark.read).format("drop_folder").option("path", path).load()


def _known(old: DataFrame | None, ids: Column) -> tuple[DataFrame | None, Column]:
    return (None, F.lit(False)) if old is None else (old.select(ids.alias("doc_id"), F.lit(True).alias("old")).distinct(), F.coalesce("old", F.lit(False)))


def outcomes(found: DataFrame, feeds: DataFrame, as_of: str, old: DataFrame | None = None, include=(), exclude=(), max_age: int = 180) -> DataFrame:
    """Every entry of a run with its outcome: fetched, skipped, error, out_of_scope, over_limit or repeated.

    found: rows of drop_folder; feeds: feed, limit (0: none); old: documents (doc_id) that are
    there already. A feed's entries are counted off against its limit in the order of pages,
    after the scope; those beyond are over_limit. Then an entry without a link is an error, one
    that came before (a post of another query, a link of the same feed) is repeated, one more
    than max_age days old, or known, is skipped; all others are fetched. Pages that can't be read
    are errors of their own. Undated entries pass the age.
    """
    stamp = F.when(F.col("kind") == "post", F.date_format(F.try_to_date(F.substring("published", 1, 10), "yyyy-MM-dd"), "yyyy-MM-dd")).otherwise(entry_date(F.col("published"), as_of))
    tail = F.element_at(F.split("link", "/"), -1)
    did = F.when(F.col("link").contains("://"), F.substring(F.element_at(F.split(F.try_element_at(F.split("link", "/"), F.lit(3)), ":"), -1), 1, 12)).otherwise("unknown")
    x = found.withColumn("published_at", stamp)
    x = x.withColumn("doc_id", F.when(F.col("kind") == "post", F.concat(F.lit("bsky_"), did, F.lit("_"), tail)).otherwise(document_id(F.coalesce("published_at", F.lit(as_of)), F.col("feed"), F.col("link"))))
    scope = in_scope(F.when(F.col("kind") == "post", F.col("body")).otherwise(F.concat_ws(" ", "title", "body")), list(include), list(exclude))
    x = x.join(feeds.select("feed", "limit"), "feed", "left").withColumn("scoped", F.col("error").isNull() & scope)
    # a place in the feed: the scoped entries of earlier pages, from one count for each page, and those before it on its own page
    before = F.sum("n").over(Window.partitionBy("feed").orderBy("page").rowsBetween(Window.unboundedPreceding, -1))
    pages = x.groupBy("feed", "page").agg(F.count_if("scoped").alias("n")).select("feed", "page", F.coalesce(before, F.lit(0)).alias("start"))
    own = F.count_if("scoped").over(Window.partitionBy("feed", "page").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    x = x.withColumn("own", own).join(pages, ["feed", "page"]).withColumn("taken", F.col("scoped") & ((F.coalesce("limit", F.lit(0)) <= 0) | (F.col("own") + F.col("start") <= F.col("limit"))))
    live = x.where("taken and link is not null and doc_id is not null")
    first = live.groupBy("doc_id").agg(F.min(F.struct("feed", "page", "place")).alias("first"))
    x = x.join(first, "doc_id", "left")
    known, is_known = _known(old, F.col("doc_id"))
    x = x if known is None else x.join(known, "doc_id", "left")
    stale = F.datediff(F.lit(as_of).cast("date"), F.col("published_at").cast("date")) > max_age
    outcome = (
        F.when(F.col("error").isNotNull(), "error").when(~F.col("scoped"), "out_of_scope").when(~F.col("taken"), "over_limit").when(F.col("link").isNull(), "error")
        .when(F.struct("feed", "page", "place") != F.col("first"), "repeated").when(F.coalesce(stale, F.lit(False)) | is_known, "skipped").otherwise("fetched")
    )
    return x.select(*found.columns, "published_at", "doc_id", outcome.alias("outcome"))


def documents(run: DataFrame) -> DataFrame:
    """The fetched entries of a run as documents; posts have their first line as title, with the author."""
    post = F.col("kind") == "post"
    text, handle = F.coalesce("body", F.lit("")), F.coalesce("author", F.lit("unknown"))
    line = F.when(text == "", "(no text)").otherwise(F.substring(F.substring_index(text, "\n", 1), 1, 120))
    return run.where("outcome = 'fetched'").select(
        "doc_id", F.when(post, F.concat(F.lit("https://bsky.app/profile/"), handle, F.lit("/post/"), F.element_at(F.split("link", "/"), -1))).otherwise(F.col("link")).alias("url"), F.col("feed").alias("source"),
        F.when(post, F.concat(F.lit("@"), handle, F.lit(": "), line)).otherwise(F.coalesce("title", F.lit(""))).alias("title"), "published_at", text.alias("text"), F.when(text != "", F.sha2(text, 256)).alias("content_hash"),
    )


def statistics(run: DataFrame, feeds: DataFrame) -> DataFrame:
    """A row for each feed: fetched, skipped, errors, and whether any of its pages could be read. A feed without pages is not reachable."""
    n = lambda name: F.count_if(F.col("outcome") == name)
    s = run.groupBy("feed").agg(n("fetched").alias("fetched"), (n("skipped") + n("repeated")).alias("skipped"), n("error").alias("errors"), F.coalesce(F.bool_or(F.col("error").isNull()), F.lit(False)).alias("reachable"))
    return feeds.select("feed").join(s, "feed", "left").fillna(0, ["fetched", "skipped", "errors"]).fillna(False, ["reachable"])
