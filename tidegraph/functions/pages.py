"""Text, title and metadata of raw pages by fixed rules: named tags and name patterns.

One pass of the standard library's parser gives a flat list of nodes and texts; each rule is
then a walk over that list. Spark calls it on Arrow batches, one page at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tags without content, tags that are dropped, tags and names of boilerplate,
# and where the main content is looked for, in that order (attribute or tag, value).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript iframe object embed svg canvas video audio map form".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside".split())
#: Found anywhere in class or id, so `ad` also matches `read`: that is the rule.
BOILERPLATE_NAMES = re.compile(
    "nav|menu|sidebar|footer|header|banner|ad|sponsor|promo|social|share|cookie|newsletter|subscribe|signup|sign-up|comment|"
    "related|popular|trending|widget|breadcrumb|pagination|meta|byline|author|tag|categories",
    re.IGNORECASE,
)
CONTENT = (
    ("tag", "article"), ("tag", "main"), ("role", "main"), ("class", "post-content"), ("class", "article-content"), ("class", "entry-content"),
    ("class", "content"), ("class", "post"), ("class", "article"), ("id", "content"), ("id", "main"), ("id", "article"),
)
DATES = (
    ("meta", "property", "article:published_time"), ("meta", "name", "date"), ("meta", "name", "pubdate"),
    ("meta", "property", "og:published_time"), ("time", "itemprop", "datePublished"),
)
UNSEEN = frozenset(("script", "style", "template"))


class Nodes(HTMLParser):
    """Nodes in page order (parent, tag, attributes) and texts (node, text). Comments are left out."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.attrs = [-1], ["#page"], [{}]
        self.texts: list[list] = []
        self._path, self._open, self._joins = [0], Counter(), False
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.parent.append(self._path[-1])
        self.tag.append(tag)
        self.attrs.append({k: v or "" for k, v in attrs})
        self._joins = False
        if tag not in VOID:
            self._path.append(len(self.tag) - 1)
            self._open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._joins = False
        if self._open[tag]:
            while True:
                last = self.tag[self._path.pop()]
                self._open[last] -= 1
                if last == tag:
                    break

    def handle_data(self, data):
        if self._joins:
            self.texts[-1][1] += data
        else:
            self.texts.append([self._path[-1], data])
            self._joins = True

    def handle_comment(self, data):
        self._joins = False

    def below(self, start: int | None, stop) -> list[str]:
        """Stripped texts under a node (None: everywhere) and not under one for which stop(node) holds."""
        ok = [start in (None, 0) and not stop(0)]
        for i in range(1, len(self.tag)):
            ok.append((ok[self.parent[i]] or i == start) and not stop(i))
        return [s for node, x in self.texts if ok[node] and (s := x.strip())]

    def first(self, test) -> int | None:
        return next((i for i in range(1, len(self.tag)) if test(i)), None)


def _spaced(parts: list[str]) -> str:
    return " ".join(" ".join(parts).split())


def all_text(html: str | None) -> str:
    """Everything but scripts and styles; single spaces."""
    page = Nodes(html or "")
    return _spaced(page.below(None, lambda i: page.tag[i] in ("script", "style", "noscript", "template")))


def content(html: str | None) -> str:
    """The first content container without boilerplate; the body, or all, if there is none."""
    if not html or "<" not in html:
        return _spaced([html or ""])
    page = Nodes(html)
    gone = [False]
    for i in range(1, len(page.tag)):
        own, names = page.tag[i], page.attrs[i]
        gone.append(
            gone[page.parent[i]]
            or own in DROPPED
            or own in BOILERPLATE_TAGS
            or any(BOILERPLATE_NAMES.search(names.get(k, "")) for k in ("class", "id"))
        )

    def holds(i, kind, value):
        if gone[i]:
            return False
        if kind == "tag":
            return page.tag[i] == value
        found = page.attrs[i].get(kind, "")
        return value in found.split() if kind == "class" else found == value

    for kind, value in (*CONTENT, ("tag", "body")):
        start = page.first(lambda i, kind=kind, value=value: holds(i, kind, value))
        if start is not None:
            break
    return _spaced(page.below(start, gone.__getitem__))


def title(page: Nodes) -> str | None:
    """Of the first h1, else of the first title, if they have any text."""
    for tag in ("h1", "title"):
        at = page.first(lambda i, tag=tag: page.tag[i] == tag)
        if at is not None and (found := "".join(page.below(at, lambda i: page.tag[i] in UNSEEN))):
            return _spaced([found])
    return None


def metadata(page: Nodes) -> dict[str, str]:
    """author, description, published (by precedence), and the Open Graph title and description."""

    def of(tag, key, value, *names):
        at = page.first(lambda i: page.tag[i] == tag and page.attrs[i].get(key) == value)
        return None if at is None else next((page.attrs[at][n] for n in names if page.attrs[at].get(n)), None)

    out = {"author": of("meta", "name", "author", "content"), "description": of("meta", "name", "description", "content")}
    out["published"] = next((x for d in DATES if (x := of(*d, "content", "datetime"))), None)
    out["og_title"] = of("meta", "property", "og:title", "content")
    out["og_description"] = None if out["description"] else of("meta", "property", "og:description", "content")
    return out


FIELDS = "text string, content string, title string, author string, description string, published string, og_title string, og_description string"


def cleaned(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with a column `page`: text, content, title and metadata. A null page has empty texts and null fields."""

    @F.pandas_udf(FIELDS)
    def read(values: pd.Series) -> pd.DataFrame:
        rows = []
        for x in values:
            nodes = Nodes(x or "")
            rows.append({"text": all_text(x), "content": content(x), "title": title(nodes), **metadata(nodes)})
        return pd.DataFrame(rows, columns=[f.split()[0] for f in FIELDS.split(", ")], dtype=object)

    return pages.withColumn("page", read(F.col(html)))
