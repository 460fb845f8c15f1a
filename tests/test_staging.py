from decimal import Decimal

import pytest
from helpers import d, rows, ts
from pyspark.sql import functions as F

from tidemark.operators.snapshot import snapshot
from tidemark.plans import staging
from tidemark.sources.schemas import RAW

TODAY = d("2024-01-20")


def raw(spark, table, *given):
    return spark.createDataFrame(list(given), RAW[table])


def test_customers(spark):
    history = staging.customer_history(
        raw(spark, "customers", (1, d("2024-01-01"), " North ", "web ", " small"), (2, None, None, None, None)),
        None,
        ts("2024-01-18T00:00:00"),
    )
    out = staging.stage_customers(history, TODAY)
    assert rows(out, "customer_id", "region", "acquisition_channel", "size_band", "customer_tenure_days") == [
        (1, "North", "web", "small", 19),
        (2, None, None, None, None),
    ]


def test_subscriptions_are_deduplicated_and_flagged(spark):
    live = (1, 5, " voip", "p ", 10.005, d("2024-01-20"), " active ", None, 12)
    future = (2, 5, "voip", "p", 10.0, d("2024-01-21"), "active", None, 12)
    doa = (3, 5, "voip", "p", 10.0, None, "doa", d("2024-02-01"), 12)
    history = staging.subscription_history(
        raw(spark, "subscriptions", live, live, future, doa), None, ts("2024-01-18T00:00:00")
    )
    out = staging.stage_subscriptions(history, TODAY)
    assert rows(out, "subscription_id", "product_type", "plan", "status", "is_pending_activation_flag") == [
        (1, "voip", "p", "active", False),
        (2, "voip", "p", "active", True),
        (3, "voip", "p", "doa", False),
    ]
    assert rows(out.where("subscription_id = 1"), "mrr") == [(Decimal("10.01"),)]


def test_the_open_version_wins_then_the_latest(spark):
    def one(sub, status):
        return (sub, 5, "voip", "p", 10.0, d("2023-01-20"), status, None, 12)

    loads = [
        [one(1, "active"), one(2, "active"), one(3, "active")],
        [one(1, "cancelled"), one(2, "cancelled"), one(3, "active")],
        [one(1, "cancelled")],
    ]
    history = None
    for n, given in enumerate(loads):
        history = staging.subscription_history(raw(spark, "subscriptions", *given), history, ts(f"2024-01-1{n}T00:00:00"))
    out = staging.stage_subscriptions(history, TODAY)
    assert rows(out, "subscription_id", "status", F.col("valid_to").isNull()) == [
        (1, "cancelled", True),
        (2, "cancelled", False),
        (3, "active", False),
    ]


def test_copies_shrink_before_the_shuffle(spark):
    history = snapshot(raw(spark, "subscriptions"), None, "subscription_id", ["status"], ts("2024-01-18T00:00:00"))
    plan = staging.stage_subscriptions(history, TODAY)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning(subscription_id") :]
    assert "WindowGroupLimit" in before_shuffle


@pytest.mark.parametrize(("text", "number"), [("57.0", 57), ("57.6", 58), ("57", 57), (None, None)])
def test_portal_customer_ids(spark, text, number):
    out = staging.stage_portal_events(raw(spark, "portal_events", (1, text, " login ", ts("2024-01-01T01:00:00"))))
    assert rows(out, "customer_id", "event_type", "is_unattributed_flag") == [(number, "login", text is None)]


@pytest.mark.parametrize(
    ("created", "resolved", "hours"),
    [
        ("2024-01-01T00:59:00", "2024-01-01T01:01:00", 1),
        ("2024-01-01T00:01:00", "2024-01-01T00:59:00", 0),
        ("2024-03-30T23:30:00", "2024-03-31T04:30:00", 5),  # a clock change in some zones
        ("2024-01-01T10:00:00", "2023-12-31T23:00:00", -11),
        ("2024-01-01T10:00:00", None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "Europe/London"])
def test_resolution_hours(spark, created, resolved, hours, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        given = raw(spark, "support_contacts", (1, 2, ts(created), " phone", "complaint ", ts(resolved)))
        out = staging.stage_support_contacts(given)
        assert rows(out, "resolution_hours", "is_unresolved_flag", "channel", "category") == [
            (hours, resolved is None, "phone", "complaint")
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_amounts(spark):
    out = staging.stage_billings(raw(spark, "billings", (1, 2, d("2024-01-01"), 10.125, 0.0, " unpaid")))
    assert rows(out, "amount_due", "amount_paid", "status") == [(Decimal("10.13"), Decimal("0.00"), "unpaid")]
    usage = staging.stage_usage_daily(raw(spark, "usage_daily", (1, d("2024-01-01"), 3, 4.5, 2)))
    assert rows(usage) == [(1, d("2024-01-01"), 3, Decimal("4.50"), 2)]
