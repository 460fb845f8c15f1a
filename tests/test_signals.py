import random
from datetime import timedelta
from decimal import Decimal

import pytest
from helpers import d, rows, ts

from tidemark.operators.lookback import last_seen_before, rows_with_last_seen, within
from tidemark.plans import indicators

BASE = "subscription_id bigint, customer_id bigint, lifecycle_state string, is_churned boolean, reference_date date"


def base_of(spark, *given):
    return spark.createDataFrame([(s, c, "x", churned, d(ref)) for s, c, churned, ref in given], BASE)


def contacts(spark, *given):
    return spark.createDataFrame(
        [(c, category, ts(at)) for c, category, at in given], "customer_id bigint, category string, created_at timestamp_ntz"
    )


def complaint(spark, base, support, **options):
    seen = indicators.support_sightings(support)
    return [s for (s,) in rows(indicators.customer_signal(base, seen, "complaint", **options))]


@pytest.mark.parametrize(
    ("at", "hit"),
    [
        ("2023-12-31T23:59:59", True),
        ("2024-01-01T00:00:00", False),
        ("2023-11-02T00:00:00", True),  # 60 days before
        ("2023-11-01T23:59:59", False),
    ],
)
def test_window_is_half_open(spark, at, hit):
    base = base_of(spark, (1, 10, False, "2024-01-01"))
    assert complaint(spark, base, contacts(spark, (10, "complaint", at))) == ([1] if hit else [])


def test_one_contact_counts_for_all_subscriptions_of_the_customer_once(spark):
    base = base_of(
        spark,
        (1, 10, False, "2024-01-01"),
        (2, 10, True, "2023-12-25"),
        (3, 10, True, "2022-01-01"),
        (4, 11, False, "2024-01-01"),
        (5, None, False, "2024-01-01"),
    )
    support = contacts(
        spark,
        (10, "complaint", "2023-12-20T10:00:00"),
        (10, "complaint", "2023-12-21T10:00:00"),
        (11, "technical_fault", "2023-12-21T10:00:00"),
        (None, "complaint", "2023-12-21T10:00:00"),
    )
    assert complaint(spark, base, support) == [1, 2]
    assert complaint(spark, base, support, hot_rows=1) == [1, 2]


def test_latest_sighting_equals_brute_force(spark):
    pick = random.Random(7)
    start = d("2023-01-01")
    anchors = [(pick.choice([1, 1, 2, 3, None]), start + timedelta(pick.randint(0, 90)), 1) for _ in range(200)]
    events = [(pick.choice([1, 2, 4, None]), start + timedelta(pick.randint(0, 90)), pick.random() < 0.5) for _ in range(40)]
    out = last_seen_before(
        spark.createDataFrame(anchors, "k int, day date, n int"),
        spark.createDataFrame(events, "k int, seen_on date, m boolean"),
        "k", "day", ["n"], ["m"],
    ).select("k", "day", "n", within("m", "day", 10).alias("hit"))
    expected = {
        (k, day): (
            sum(1 for a in anchors if a[:2] == (k, day)),
            any(m and e == k is not None and day - timedelta(10) <= on < day for e, on, m in events),
        )
        for k, day, _ in anchors
    }
    assert {(r.k, r.day): (r.n, r.hit) for r in out.collect()} == expected


@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
def test_rows_with_last_seen_equal_brute_force(spark, hot_rows):
    pick = random.Random(hot_rows)
    start = d("2023-01-01")

    def on():
        return start + timedelta(pick.randint(0, 90))

    anchors = [(i, pick.choice([1, 1, 1, 2, 3, None]), pick.choice([None, on(), on()])) for i in range(300)]
    events = [(pick.choice([1, 2, 4, None]), pick.choice([None, on(), on()]), pick.random() < 0.5) for _ in range(60)]
    out = rows_with_last_seen(
        spark.createDataFrame([*anchors, *anchors[:9]], "i int, k int, day date"),
        spark.createDataFrame(events, "k int, seen_on date, m boolean"),
        "k", "day", ["m"], hot_rows,
    )
    wanted = []
    for i, k, day in [*anchors, *anchors[:9]]:
        seen = [o for e, o, m in events if m and e is not None and e == k and o and day and o < day]
        wanted.append((i, k, day, max(seen, default=None)))
    assert sorted(map(repr, (tuple(r) for r in out.collect()))) == sorted(map(repr, wanted))


def usage(spark, *given):
    return spark.createDataFrame(
        [(s, d(on), calls, Decimal(str(minutes)) if minutes is not None else None, peak) for s, on, calls, minutes, peak in given],
        "subscription_id bigint, usage_date date, call_count bigint, call_minutes decimal(10,2), concurrent_peak bigint",
    )


@pytest.mark.parametrize("hot_rows", [1_000_000, 0])
def test_usage_signals(spark, hot_rows):
    ref = "2024-03-01"  # halves of the window: 2024-01-01 to 01-30, 01-31 to 02-29
    base = base_of(spark, *[(s, s, False, ref) for s in range(1, 11)])
    out = indicators.usage_flags(
        base,
        usage(
            spark,
            (1, "2024-02-01", 1, 10, 1),  # nothing before
            (2, "2024-01-05", 1, 100, 1), (2, "2024-02-05", 1, 50, 1),  # exactly half
            (3, "2024-01-05", 1, 100, 1), (3, "2024-02-05", 1, 49, 1),  # dropped
            (4, "2024-01-30", 1, 100, 1), (4, "2023-12-31", 1, 999, 9),  # none recently; earlier days do not count
            (5, "2024-01-31", 1, 100, 1), (5, "2024-03-01", 1, 100, 9),  # the boundary is recent; the reference day is out
            (6, "2024-02-01", 0, 0, 8),  # peak on a day without calls
            (7, "2024-02-01", 1, 1, 7),
            (8, "2024-01-01", 1, 1, 8), (8, "2024-02-01", 1, 1, 1),
            (9, "2024-01-05", 1, 60, 1), (9, "2024-01-05", 1, 60, 1), (9, "2024-02-05", 1, 59, 1),  # a day given twice
        ),
        hot_rows=hot_rows,
    )
    assert rows(out.where("usage_drop"), "subscription_id") == [(3,), (4,), (9,)]
    assert rows(out.where("peak"), "subscription_id") == [(8,)]
    assert out.count() == 9  # 10 has no usage


@pytest.mark.parametrize(("threshold", "drops"), [(-0.33337, False), (-0.33336, True), (-12.5, False)])
def test_the_threshold_is_taken_as_given(spark, threshold, drops):
    days = usage(spark, (1, "2024-01-05", 1, 300, 1), (1, "2024-02-05", 1, 199.99, 1), (1, "2024-02-06", 1, 0.0, 1))
    base = base_of(spark, (1, 1, False, "2024-03-01"))
    assert indicators.usage_flags(base, days, drop_threshold=threshold).first().usage_drop is drops


def test_scan(spark):
    base = base_of(
        spark,
        (1, 10, True, "2023-12-01"),
        (2, 10, True, "2022-12-01"),
        (3, 11, False, "2024-01-01"),
        (4, 12, False, "2024-01-01"),
        (5, 12, False, "2024-01-01"),
        (6, 13, False, "2024-01-01"),
    )
    scan = indicators.leading_indicator_scan(
        base,
        contacts(spark, (10, "complaint", "2023-11-20T01:00:00"), (12, "complaint", "2023-12-31T01:00:00")),
        spark.createDataFrame(
            [(13, "support_ticket_open", ts("2023-12-30T00:00:00")), (None, "support_ticket_open", ts("2023-12-30T00:00:00"))],
            "customer_id bigint, event_type string, event_timestamp timestamp_ntz",
        ),
        spark.createDataFrame([(10, "unpaid", d("2023-11-01"))], "customer_id bigint, status string, period_month date"),
        usage(spark, (6, "2023-12-30", 3, 5, 12)),
    )
    found = {r.signal_name: tuple(r)[1:] for r in scan.collect()}
    assert found == {
        "support_complaint_60d": (2, 1, 50.0, 4, 2, 50.0, 1.0),
        "portal_support_ticket_open_60d": (2, 0, 0.0, 4, 1, 25.0, 0.0),
        "technical_fault_60d": (2, 0, 0.0, 4, 0, 0.0, None),
        "usage_minutes_drop_50pct_30d": (2, 0, 0.0, 4, 0, 0.0, None),
        "billing_unpaid_or_partpaid_60d": (2, 1, 50.0, 4, 0, 0.0, None),
        "concurrent_peak_top_decile_60d": (2, 0, 0.0, 4, 1, 25.0, 0.0),
    }
    ratios = [r.risk_ratio for r in scan.collect()]
    assert ratios == [None, None, None, 1.0, 0.0, 0.0]  # nulls first


def test_scan_of_an_empty_base(spark):
    base = base_of(spark, (1, 1, True, "2024-01-01")).where("false")
    scan = indicators.leading_indicator_scan(
        base,
        contacts(spark, (1, "complaint", "2023-12-31T01:00:00")),
        spark.createDataFrame([], "customer_id bigint, event_type string, event_timestamp timestamp_ntz"),
        spark.createDataFrame([], "customer_id bigint, status string, period_month date"),
        usage(spark, (6, "2023-12-30", 3, 5, 12)),
    )
    assert {tuple(r)[1:] for r in scan.collect()} == {(0, 0, None, 0, 0, None, None)}
    assert scan.count() == 6
