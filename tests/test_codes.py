"""Ids move as numbers, relations that a document fixes are dealt once, and fronts meet the edges as they are."""

import re

import pytest
from pyspark.sql import functions as F

from tidegraph.operators import graph, resolve
from tidegraph.plans.registry import QUERIES
from tidegraph.sources import testdata as t

SF = "/root/testdata/sf0.001"


def plan(spark, name, which="executedPlan"):
    return getattr(QUERIES[name](spark, SF)._jdf.queryExecution(), which)().toString()


def test_codes_and_texts(spark):
    numbers = [0, 1, 7, 123456789012, -5, None]
    d = spark.createDataFrame([(n,) for n in numbers], "n long")
    for kind in t.KINDS:
        got = d.select(F.concat(F.lit(kind + ":"), "n").alias("want"), t.text(t.coded(kind, "n")).alias("got")).collect()
        assert [r["got"] for r in got] == [r["want"] for r in got]
    assert d.where("n = 7").select(t.coded("nation", "n")).first()[0] == t.code("nation:7")


@pytest.mark.parametrize("name", ["n6_merge_relations", "w2_dedup"])
def test_relations_of_a_document_are_dealt_with_their_lines(spark, name):
    """no shuffle holds relations, or texts of ids."""
    dealt = [line for line in plan(spark, name).splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and not any(c in line for line in dealt for c in ("rel#", "source_id#", "doc#"))


def test_edges_are_grouped_by_codes(spark):
    """ends are numbers until edges are whole."""
    groups = [line for line in plan(spark, "g2_edge_aggregation", "optimizedPlan").splitlines() if "Aggregate [source_id" in line]
    assert groups and "min_by" not in "".join(groups)
    assert dict(t.relations(spark, SF, t.coded).dtypes)["source_id"] == "bigint"


@pytest.mark.parametrize("name", ["g10_trending_nodes", "g10_trending_edges"])
def test_trending_entities_are_found_once(spark, name):
    """the ranking is not made again by each of its readers."""
    assert "GlobalLimit" not in plan(spark, name, "optimizedPlan")


def test_bridges_filter_before_they_put_equal_edges_together(spark):
    e = spark.createDataFrame([("t1", "t2"), ("t3", "b"), ("t3", "b"), ("b", "t1"), ("x", "y")], "source_id string, target_id string")
    b = graph.bridges(e, spark.createDataFrame([(f"t{i}",) for i in range(1, 4)], "entity_id string"))
    assert [tuple(r) for r in b.collect()] == [("b", 2, 1)]
    assert not re.search(r"Aggregate \[source_id#\d+, target_id#\d+\], ", b._jdf.queryExecution().optimizedPlan().toString())


@pytest.mark.parametrize("name", ["g12_focus", "p15_region_lens"])
def test_fronts_write_no_edges(spark, name, monkeypatch):
    """only fronts are written."""
    written = []
    real = graph.materialise
    monkeypatch.setattr(graph, "materialise", lambda d, label: written.append(set(d.columns)) or real(d, label))
    QUERIES[name](spark, SF).collect()
    assert written and all("a" not in c and "b" not in c for c in written)


def test_islands_put_ends_together_first(spark):
    """F23."""
    assert "Aggregate [entity_id" in plan(spark, "g17_islands", "optimizedPlan")


@pytest.mark.parametrize("name", ["u2_union_distinct", "g8_strip_orphans"])
def test_parts_grow_with_lines(spark, name):
    """a task has the rows of so many lines, whatever the size of the tables."""
    assert t.parts(spark, SF, 1000) == -(-t.table(spark, SF, "lineitem").count() // 1000)
    assert "REPARTITION_BY_NUM" in plan(spark, name)


def test_missing_documents(spark):
    r = spark.createDataFrame([(1, 8, "X", 16, "k", None), (2, 8, "X", 16, "k", None), (3, 8, "X", 16, "k", 8)], "relation_id long, source_id long, rel string, target_id long, kind string, doc_id long")
    assert sorted((x["doc"] or 0, x["relation_id"], x["dropped"]) for x in graph.dedup(r).collect()) == [(0, 1, 1), (8, 3, 0)]
    m = resolve.merged(r.withColumns({"s": F.lit(None).cast("long"), "t": F.lit(24).cast("long")}))
    assert sorted((x["doc"] or 0, x["target_id"], x["relation_id"], x["merged"]) for x in m.collect()) == [(0, 24, 1, 2), (8, 24, 3, 1)]
