"""Answers are read once by every query on them."""

import pytest
from pyspark.sql import functions as F

from tidegraph.operators import extraction
from tidegraph.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
READERS = ["e11_verdict", "e12_import_links", "e12_import_states", "e12_import_evidence", "e9_zero_value", "e1_parse_answers", "e13_models", "e8_orphan_rate", "e6_validate", "e10_bare_assertions"]


@pytest.mark.parametrize("name", READERS)
def test_each_answer_is_parsed_once_and_lines_are_scanned_once(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    assert plan.count("l_discount#") > 0 and plan.count("l_partkey") > 0
    scans = sum(line.lstrip(" :+-").startswith("Relation [") and "l_discount" in line for line in plan.splitlines())
    assert scans == (2 if name == "e11_verdict" else 1)  # the verdict's texts come from the lines as well


def test_odd_answers(spark):
    odd = {
        "": None, "sorry": None, '{"docId":"a"': None, '```json\n{"docId":"q"}\n```': "q", 'so: ```{"docId":"q"}``` end': "q", '{"docId":"``` ```"}': "``` ```",
        '{"docId":"p","relations":[{"confidence":"high"}]}': "p", '```json {"docId":"b"} no end': None, '  {"docId":"p"}  ': "p",
    }
    p = extraction.parse(spark.createDataFrame([(a, a) for a in odd], "doc_id string, answer string"))
    assert {r["doc_id"]: r["d"] for r in p.select("doc_id", F.col("x.docId").alias("d")).collect()} == odd
