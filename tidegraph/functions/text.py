"""Text helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slugify(c: Column) -> Column:
    """Lower case, runs of other characters to one underscore; `source` when nothing is left."""
    s = F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_")
    s = F.regexp_replace(s, "^_+|_+$", "")
    return F.coalesce(F.when(s != "", s), F.lit("source"))


def short_hash(c: Column) -> Column:
    return F.substring(F.sha1(c), 1, 8)


def document_id(day: Column, source: Column, url: Column) -> Column:
    return F.concat_ws("_", day, slugify(source), short_hash(url))


def normalize_name(c: Column) -> Column:
    s = F.regexp_replace(F.lower(F.trim(c)), r"(?U)\s+", " ")
    s = F.regexp_replace(s, r"(?U)[^\w\s-]", "")
    return F.trim(F.regexp_replace(s, r"(?U)\s+", " "))


def compact(c: Column) -> Column:
    return F.regexp_replace(c, "[ -]", "")


def name_similarity(a: Column, b: Column) -> Column:
    """Of two normalized names: equal, equal when compacted, one within the other, else shared words."""
    wa, wb = (F.array_distinct(F.split(x, " ")) for x in (a, b))
    both, either = F.size(F.array_intersect(wa, wb)), F.size(F.array_union(wa, wb))
    jaccard = both / either
    shorter, longer = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    return (
        F.when(a == b, 1.0)
        .when((a == "") | (b == ""), 0.0)
        .when(compact(a) == compact(b), 1.0)
        .when(a.contains(b) | b.contains(a), shorter / longer)
        .when(both >= F.least(F.size(wa), F.size(wb)), F.greatest(jaccard, F.lit(0.7)))
        .otherwise(jaccard)
    )


def collapse(c: Column) -> Column:
    """Lower case with white space as single spaces, trimmed."""
    return F.trim(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))


def url_host(c: Column) -> Column:
    return F.try_parse_url(c, F.lit("HOST"))
