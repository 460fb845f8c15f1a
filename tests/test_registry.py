"""Every registered query against its SQL on the smallest data, and what its plan must not contain."""

import re

import pytest
from compare import contract, differences, duck

SF = "/root/testdata/sf0.001"
# the training-data queries, where they are registered, have tests of their own
NAMES = sorted(n for n in contract.queries() if not re.match(r"op\d+_|pipeline$", n))


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(NAMES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 12


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, SF, name) == []


@pytest.mark.parametrize(
    "name",
    ["subscription_monthly", "churn_metrics", "leading_indicator_scan", "snapshot_subscriptions", "dash_at_risk_customers",
     "signal_billing", "signal_peak", "dq_referential_integrity"],
)
def test_plan_stays_in_the_jvm_without_pairing_all_rows(spark, name):
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert word not in plan


@pytest.mark.parametrize("name", [n for n in NAMES if n not in contract._stored_queries()])  # those write and read back
def test_building_a_query_runs_no_job(spark, name):
    group = f"building {name}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        contract.queries()[name](spark, SF)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", NAMES)
def test_plans_stay_small(spark, name):
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 24 and plan.count("Exchange ") <= 40


@pytest.mark.parametrize(
    ("name", "found"),
    [("dq_profile", "n_violations"), ("dq_referential_integrity", "n_orphans"), ("dq_key_uniqueness", "n_keys_repeated"),
     ("dq_full_row_duplicates", "n_repeated")],
)
def test_every_quality_check_has_something_to_find(spark, name, found):
    rows = contract.queries()[name](spark, "/root/testdata/sf0.01").collect()
    assert rows and all(r[found] > 0 for r in rows)
