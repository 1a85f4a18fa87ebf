"""Every registered query against its SQL, and rules that hold for all plans."""

import pytest
from check import compare, connect

from tubewave.plans.catalog import load_catalog

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = load_catalog()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    verdict = compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert verdict.startswith("ok") or verdict == "EMPTY", verdict


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert len(df.columns) == len(set(df.columns))
    df.write.format("noop").mode("overwrite").save()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ["depth_agreement_by_type", "label_to_best_prediction_j3", "clean_neighbours_j9", "merged_across_zero_m6", "nearest_axis_index_p2"])
def test_no_pairwise_joins(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_conditions_and_columns_reach_the_scan(spark):
    plan = QUERIES["scans_by_fields_p5"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "o_totalprice" not in schema
