"""Views of a window take its lines before they are made into texts."""

import pytest

from tidegraph.plans.registry import QUERIES


@pytest.mark.parametrize("name", ["g5_claims_view", "g7_all_view"])
def test_windows_join_once_by_number(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Join ")]
    assert len(joins) == 1 and "l_orderkey" in joins[0] and "doc_id" not in joins[0]
