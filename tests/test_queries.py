"""Every registered query against its SQL twin, and what its plan must not contain."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import connect, same
from tastegrid.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
# Their column set follows the data: compared at the scale the SQL names.
BY_SCALE = {"tfidf_wide": "/root/testdata/sf0.01", "item_features": "/root/testdata/sf0.01"}

SCORED = ("file_feature_map", "recommend_half_step", "recommend_mf", "recommend_hybrid", "metrics_ranking_mf", "metrics_ranking_models", "feature_step")


@pytest.fixture(scope="module")
def results(spark):
    kept = {}

    def get(name):
        if name not in kept:
            kept[name] = queries()[name](spark, BY_SCALE.get(name, FOLDER))
        return kept[name]

    return get


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(results, name):
    con = connect(BY_SCALE.get(name, FOLDER))
    assert same(results(name).toPandas(), con.sql(oracle_sql()[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(results, name):
    """No product of tables; Python only where a caller's extractor runs or blocks of items are scored."""
    plan = plan_of(results(name))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in SCORED:
        assert "Python" not in plan and "MapInPandas" not in plan


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["user_id", "artist_id", "artist", "rating"] and not df.isEmpty()
