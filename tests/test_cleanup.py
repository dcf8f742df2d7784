"""Cleaning, lookups and cluster summaries on small tables."""

from pyspark.sql import functions as F

from tidegraph.operators import cleanup as c
from tidegraph.operators.resolve import similar_pairs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_resolutions_and_types(spark):
    d = spark.createDataFrame([("week", "ORG"), ("approximate", "org"), ("soon", "x"), (None, None)], "r string, t string")
    got = rows(d.select(c.resolution(F.col("r")), c.canonical_type(F.col("t"), ["Org", "Person"])))
    assert got == sorted([("range", "Org"), ("unknown", "Org"), ("soon", "x"), (None, None)], key=str)


def test_age_in_hours(spark):
    d = spark.createDataFrame([("2024-01-30 12:00:00",), (None,)], "s string")
    assert rows(d.select(c.age_hours(F.col("s"), "2024-01-31 18:00:00"))) == [(30.0,), (None,)]


def test_alias_ends_the_search(spark):
    names = spark.createDataFrame([("1", "Org", "Open AI"), ("2", "Org", "OpenAI"), ("3", "Person", "OpenAI")], "id string, type string, name string")
    aliases = spark.createDataFrame([("OpenAI", "9")], "alias string, id string")
    asked = spark.createDataFrame([("OpenAI", "Org"), ("open ai", "Org"), (None, "Org"), ("none such", "Org")], "query string, type string")
    assert rows(c.lookup(asked, names, aliases)) == [("OpenAI", "Org", "9", 1.0), ("open ai", "Org", "1", 1.0), ("open ai", "Org", "2", 1.0)]


def test_lookup_finds_what_all_pairs_find(spark):
    words = ("acme", "acme corp", "ac", "corp of acme", "beta", "beta-max", "betamax", "b")
    names = spark.createDataFrame([(w, "Org", w) for w in words], "id string, type string, name string")
    aliases = spark.createDataFrame([], "alias string, id string")
    asked = names.select(F.col("name").alias("query"), "type")
    got = rows(c.lookup(asked, names, aliases, 0.3).select("query", "id"))
    every = asked.crossJoin(names.select("id", "name")).where(c.name_similarity(F.col("query"), F.col("name")) >= 0.3)
    assert got == rows(every.select("query", "id")) and len(got) > len(words)


def test_clusters(spark):
    members = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "cluster int, doc_id string")
    mentions = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("a", "y"), ("b", "y"), ("a", "z"), ("c", "x")], "doc_id string, entity_id string")
    shared = c.shared_entities(members, mentions)
    assert rows(shared) == [(1, "x", 2), (1, "y", 2)]
    edges = spark.createDataFrame([(1, "x", "OWNS", "y"), (2, "x", "MENTIONS", "y"), (3, "x", "OWNS", "z"), (4, "y", "OWNS", "x")], "relation_id int, source_id string, rel string, target_id string")
    assert rows(c.inner_edges(shared, edges)) == [(1, 1, "x", "OWNS", "y"), (1, 4, "y", "OWNS", "x")]
    assert rows(c.inner_edges(shared, edges, cap=1)) == [(1, 1, "x", "OWNS", "y")]


def test_backfill_limits_before_it_excludes(spark):
    bench = spark.createDataFrame([("a", 0.9), ("b", 0.8), ("c", 0.8), ("d", 0.1)], "doc_id string, quality_score double")
    chosen = spark.createDataFrame([("a",)], "doc_id string")
    assert rows(c.light_day_backfill(chosen, bench, 3)) == [("b", 0.8), ("c", 0.8)]


def test_promotion_needs_every_mean(spark):
    runs = spark.createDataFrame([("m", 1, 0.9, 0.9), ("m", 1, 0.9, 0.7), ("n", 1, None, 0.9), ("n", 1, None, 0.9)], "model string, schema_valid int, entity_pct double, relation_pct double")
    assert rows(c.promotion(runs, docs=2).select("model", "promotable")) == [("m", 1), ("n", 0)]


def test_similar_pairs_include_names_inside_words(spark):
    words = ("ac", "acme", "b", "beta", "betamax")
    names = spark.createDataFrame([(w, "Org", w, i) for i, w in enumerate(words)], "id string, type string, name string, ord int")
    got = rows(similar_pairs(names, 0.25).select("a", "b"))
    assert got == [("ac", "acme"), ("b", "beta"), ("beta", "betamax")]


def test_repair(spark):
    rows = [(1, "cleaned", None, "<p>a <b>b</b></p>"), (2, "cleaned", None, None), (3, "cleaned", "t", None), (4, "error", None, "<p>x</p>"), (5, None, None, None)]
    d = spark.createDataFrame(rows, "doc_id int, status string, text string, html string")
    got = {r["doc_id"]: (r["done"], r["status"], r["text"], r["error"] is None, r["content_hash"] is None) for r in c.repair(d).collect()}
    assert got == {
        1: ("recovered", "cleaned", "a b", True, False), 2: ("lost", "error", None, False, True), 3: ("kept", "cleaned", "t", True, False),
        4: ("kept", "error", None, True, True), 5: ("kept", None, None, True, True),
    }
