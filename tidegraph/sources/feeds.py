"""Feed configuration, and readers by type of feed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The fields of a feed's configuration and their defaults.
DEFAULTS = {"name": None, "url": None, "type": "rss", "enabled": "true", "limit": "0", "tier": "1", "signal": "primary"}

READERS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def feed_config(lines: DataFrame, disabled: bool = False) -> DataFrame:
    """Feeds of a column `value` of JSON objects; fields that are not known go into the map `extra`.

    Missing fields have their defaults. Disabled feeds, and rows without a readable object or a name, are left out.
    """
    x = lines.select(F.from_json("value", "map<string,string>").alias("m"))
    get = lambda k: F.coalesce(F.try_element_at("m", F.lit(k)), F.lit(DEFAULTS[k]).cast("string"))
    kind = {"enabled": "boolean", "limit": "int", "tier": "int"}
    known = list(DEFAULTS)
    f = x.select(*(get(k).cast(kind.get(k, "string")).alias(k) for k in known), F.map_filter("m", lambda k, v: ~k.isin(known)).alias("extra")).where("name is not null")
    return f if disabled else f.where("enabled")


def reader(kind: str):
    """Registers the reader of a type: feeds of that type in, documents out."""

    def put(f):
        READERS[kind] = f
        return f

    return put


def dispatch(feeds: DataFrame) -> DataFrame:
    """Documents of all feeds, each type read by its reader; a type without a reader is an error."""
    kinds = sorted(r["type"] for r in feeds.select("type").distinct().limit(len(READERS) + 1).collect())
    unknown = [k for k in kinds if k not in READERS]
    if unknown:
        raise ValueError(f"no reader for feeds of type {unknown}; known: {sorted(READERS)}")
    out = None
    for k in kinds:
        d = READERS[k](feeds.where(F.col("type") == k))
        out = d if out is None else out.unionByName(d)
    if out is None:
        raise ValueError("no feeds")
    return out
