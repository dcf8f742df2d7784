"""The greedy pass against the loop: drawn graphs, long chains, equal names, and sides that exist already."""

import random

import pytest
from pyspark.sql import functions as F

from tidegraph.operators import resolve


def loop(ids, pairs):
    """ids in order; pairs (earlier, later)."""
    to = {}
    for i in ids:
        if i not in to:
            to[i] = i
            for b in ids:
                if (i, b) in pairs and b not in to:
                    to[b] = i
    return to


def assigned(spark, ids, pairs):
    place = {x: i for i, x in enumerate(ids)}
    n = spark.createDataFrame([(x,) for x in ids], "id string")
    p = spark.createDataFrame([(a, b, place[a]) for a, b in pairs], "a string, b string, oa int")
    return {r["id"]: r["canonical"] for r in resolve.assign(n, p).collect()}


@pytest.mark.parametrize(("seed", "size", "density"), [(1, 40, 0.03), (2, 40, 0.08), (3, 30, 0.2), (4, 60, 0.04), (5, 12, 0.5)])
def test_drawn_graphs(spark, seed, size, density):
    r = random.Random(seed)
    ids = [f"e{i:02}" for i in range(size)]
    r.shuffle(ids)
    pairs = {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if r.random() < density}
    assert assigned(spark, ids, pairs) == loop(ids, pairs)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    n = 1000
    ids = [f"c{i:04}" for i in range(n)] + ["s1", "s2"]
    pairs = {(ids[i], ids[i + 1]) for i in range(n - 1)} | {(ids[n - 1], "s1"), (ids[500], "s1"), (ids[3], "s2"), ("s1", "s2")}
    labels, own = [], resolve.materialise
    monkeypatch.setattr(resolve, "materialise", lambda d, label: labels.append(label) or own(d, label))
    assert assigned(spark, ids, pairs) == loop(ids, pairs)
    assert labels.count("fresh") <= 5 and labels.count("chain") < 15 * 3


def test_no_pairs_and_no_names(spark):
    assert assigned(spark, ["b", "a"], set()) == {"a": "a", "b": "b"}
    assert assigned(spark, [], set()) == {}


def test_equal_names_are_members_not_pairs(spark, monkeypatch):
    seen, own = [], resolve.similar_pairs
    monkeypatch.setattr(resolve, "similar_pairs", lambda names, *a, **k: seen.append(names.count()) or own(names, *a, **k))
    d = spark.range(10_000).select(F.concat(F.lit("e"), "id").alias("id"), F.lit("T").alias("type"), (10_000 - F.col("id")).alias("ord"), F.lit("Open  Lab").alias("name"))
    more = spark.createDataFrame([("x", "T", 0, "open lab!"), ("y", "U", 0, "open lab"), ("z", "T", 20_000, "Open Lab Two"), ("blank", "T", 1, "!"), ("blank2", "T", 2, "?")], "id string, type string, ord long, name string")
    got = {r["id"]: r["canonical"] for r in resolve.resolve_names(d.union(more), 0.6).collect()}
    assert len(got) == 10_005 and {got[f"e{i}"] for i in range(10_000)} == {"x"}
    assert (got["x"], got["y"], got["z"], got["blank"], got["blank2"]) == ("x", "y", "x", "blank", "blank2") and seen == [5]


def test_names_with_repeats_equal_the_pass_over_all(spark):
    r = random.Random(9)
    words = "open ai gpt 4 turbo deep mind lab x y".split()
    rows = [(f"e{i}", r.choice("TTU"), i, " ".join(r.choice(words) for _ in range(r.randint(1, 2)))) for i in range(70)]
    d = spark.createDataFrame(rows, "id string, type string, ord int, name string")
    every = resolve.assign(d, resolve.similar_pairs(d, 0.6))
    assert sorted(map(tuple, resolve.resolve_names(d, 0.6).collect())) == sorted(map(tuple, every.collect()))


def test_resolve_or_create(spark):
    old = [("org:open_ai", "Open AI", "Org", "2024-01-01", "2024-01-05"), ("org:deep_lab", "Something", "Org", "2024-01-01", None), ("org:deep_lab_2", "Else", "Org", "2024-01-01", "2024-03-01"), ("org:deep_lab_4", "More", "Org", None, None), ("tool:x_9", "X", "Tool", None, "2024-01-01")]
    e = spark.createDataFrame(old, "entity_id string, name string, type string, first_seen string, last_seen string")
    aliases = spark.createDataFrame([("OAI", "org:open_ai")], "alias string, entity_id string")
    batch = [
        ("open-ai", "Org", "2024-02-02", 1), ("OAI", "Org", "2024-02-03", 2), ("Deep Lab", "Org", "2024-02-04", 3), ("deep lab!", "Org", "2024-02-09", 4), ("Deep Lab", "Org", "2024-02-01", 9), ("deep  lab  of the deep", "Org", "2024-02-05", 5),
        ("X", "Org", "2024-02-06", 6), ("x", "Tool", "2023-12-31", 7), ("Deep Lab", "Tool", "2024-02-07", 8), (None, "Org", "2024-02-07", 8), ("no type", None, "2024-02-07", 8), ("!!", "Org", None, 10), ("??", "Org", "2024-02-08", 11),
    ]
    after, mapping = resolve.resolve_or_create(spark.createDataFrame(batch, "name string, type string, day string, ord int"), e, aliases, 0.85)
    got = {(r["name"], r["type"]): (r["entity_id"], r["created"]) for r in mapping.collect()}
    assert got == {
        ("open-ai", "Org"): ("org:open_ai", False), ("OAI", "Org"): ("org:open_ai", False), ("Deep Lab", "Org"): ("org:deep_lab_3", True), ("deep lab!", "Org"): ("org:deep_lab_3", True), ("deep  lab  of the deep", "Org"): ("org:deep_lab_of_the_deep", True),
        ("X", "Org"): ("org:x", True), ("x", "Tool"): ("tool:x_9", False), ("Deep Lab", "Tool"): ("tool:deep_lab", True), ("!!", "Org"): ("org:source", True), ("??", "Org"): ("org:source_2", True),
    }
    rows = {r["entity_id"]: tuple(r)[1:] for r in after.collect()}
    assert len(rows) == after.count() == 11
    assert rows["org:open_ai"] == ("Open AI", "Org", "2024-01-01", "2024-02-03") and rows["org:deep_lab_3"] == ("Deep Lab", "Org", "2024-02-04", "2024-02-09")
    assert rows["tool:x_9"][3] == "2024-01-01" and rows["org:deep_lab"] == old[1][1:] and rows["org:source"][2:] == (None, None)
    again, mapping = resolve.resolve_or_create(spark.createDataFrame(batch, "name string, type string, day string, ord int"), after, aliases, 0.85)
    assert {(r["name"], r["type"]): r["entity_id"] for r in mapping.where("name not in ('!!', '??')").collect()} == {k: v[0] for k, v in got.items() if k[0] not in ("!!", "??")}
    none, _ = resolve.resolve_or_create(spark.createDataFrame([], "name string, type string, day string, ord int"), e, aliases)
    assert sorted(map(tuple, none.collect())) == sorted(old)
