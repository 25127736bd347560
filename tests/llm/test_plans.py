"""What the plans of the operators must not contain."""

import pytest

from tastegrid.llm import queries

SF = "/root/testdata/sf0.001"
PYTHON = ("Python", "MapInPandas", "MapInArrow", "FlatMapGroups", "FlatMapCoGroups")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op1_mixing", "op7_url_filter", "op9_sharding"])
def test_native_operators_start_no_python(spark, name):
    plan = plan_of(queries.QUERIES[name](spark, SF))
    assert not [x for x in PYTHON if x in plan]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_operator_pairs_all_rows(spark, name):
    plan = plan_of(queries.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
