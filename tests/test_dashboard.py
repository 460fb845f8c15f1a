import random
from datetime import date, timedelta

import pytest
from helpers import d, rows, subscription, subscriptions

from tidemark.plans import dashboard, facts
from tidemark.plans.lifecycle import subscription_lifecycle

TODAY = d("2024-01-20")
BILLINGS = "customer_id bigint, status string, period_month date"


def some_tables(spark, seed):
    pick = random.Random(seed)

    def on(missing):
        return None if pick.random() < missing else str(date(2022, 10, 1) + timedelta(pick.randint(0, 480)))

    given = []
    for i in range(150):
        status = pick.choice(["active", "active", "cancelled", "fraud", None])
        given.append(subscription(i, pick.choice([1, 2, 3, 4 + i, None]), on(0.1), status, on(0.1) if status == "cancelled" else None))
    open_ones = [(pick.choice([1, 2, 3, 4 + i, None]), pick.choice(["paid", "unpaid", "part_paid"]), d(on(0.1))) for i in range(150)]
    return subscription_lifecycle(subscriptions(spark, *given)), spark.createDataFrame(open_ones, BILLINGS)


@pytest.mark.parametrize("seed", [1, 2])
def test_kpis_equal_the_datasets_they_sum_up(spark, seed):
    states, billings = some_tables(spark, seed)
    customers = spark.createDataFrame([], "customer_id bigint, region string, valid_to timestamp_ntz")
    rates = [r.annualised_churn_rate_pct for r in facts.churn_metrics(states, TODAY).collect()]
    rates = [round(r * 100) for r in rates if r is not None]
    at_risk = dashboard.at_risk_customers(states, billings, customers, TODAY).count()
    assert at_risk > 0
    assert dict(rows(dashboard.kpis(states, billings, TODAY))) == {
        "mean_annualised_churn_rate_pct": sum(rates) / (len(rates) * 100),
        "active_subscriptions": states.where("lifecycle_state = 'active'").count(),
        "at_risk_customers": at_risk,
    }


def test_kpis_of_nothing(spark):
    states, billings = some_tables(spark, 1)
    found = dict(rows(dashboard.kpis(states.where("false"), billings, TODAY)))
    assert found == {"mean_annualised_churn_rate_pct": None, "active_subscriptions": 0.0, "at_risk_customers": 0.0}


def test_kpis_read_the_lifecycle_once(spark, tmp_path):
    states, billings = some_tables(spark, 1)
    states.write.parquet(str(tmp_path / "states"))
    plan = dashboard.kpis(spark.read.parquet(str(tmp_path / "states")), billings, TODAY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
