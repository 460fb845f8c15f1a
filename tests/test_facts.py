from helpers import d, rows, subscription, subscriptions

from tidemark.plans import facts
from tidemark.plans.facts import churn_denominator, churn_metrics, churn_numerator, subscription_monthly
from tidemark.plans.lifecycle import subscription_lifecycle

S = subscription
TODAY = d("2024-01-20")


def lifecycle(spark, *given):
    df = subscriptions(spark, *given)
    return subscription_lifecycle(df)


def cancelled(sub, go_live, end):
    return S(sub, sub, go_live, "cancelled", end)


def test_months_of_a_subscription(spark):
    out = subscription_monthly(
        lifecycle(
            spark,
            cancelled(1, "2023-05-03", "2023-05-20"),
            cancelled(2, "2023-05-31", "2023-06-01"),
            cancelled(3, "2023-05-03", "2023-04-30"),  # ends before it starts: no row, no error
            cancelled(4, "2023-12-15", "2024-02-10"),  # ends in the future
            S(5, 5, "2023-12-31"),
            S(6, 6, None),
            S(7, 7, "2023-01-01", status="fraud"),
        ),
        TODAY,
    )
    assert rows(out, "subscription_id", "activity_month") == [
        (1, d("2023-05-01")),
        (2, d("2023-05-01")),
        (2, d("2023-06-01")),
        (4, d("2023-12-01")),
        (4, d("2024-01-01")),
        (4, d("2024-02-01")),
        (5, d("2023-12-01")),
        (5, d("2024-01-01")),
    ]


def test_trailing_months(spark):
    states = lifecycle(spark, S(1, 1, "2023-03-01"))
    months = [r.churn_month for r in churn_metrics(states, TODAY).collect()]
    assert len(months) == 12 and months[0] == d("2023-01-01") and months[-1] == d("2023-12-01")
    assert months == sorted(months)
    assert churn_metrics(states, TODAY, months=15).first().churn_month == d("2022-10-01")


def by_month(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_churn_edges(spark):
    states = lifecycle(
        spark,
        S(1, 1, "2023-03-01"),  # live on the 1st: in the base from April
        cancelled(2, "2022-01-05", "2023-06-01"),  # cancelled on the 1st: still in June's base
        cancelled(3, "2023-08-02", "2023-08-30"),  # comes and goes within a month: numerator only
        cancelled(4, "2022-01-01", "2022-12-31"),  # gone before the window
        cancelled(5, "2023-09-01", "2023-10-01"),  # 30 days
        cancelled(6, "2023-09-01", "2023-10-02"),  # 31 days
        cancelled(7, "2023-10-15", "2024-01-10"),  # leaves in the unfinished month
        S(8, 8, "2022-01-01", status="cancelled", cancelled=None),
    )
    out = by_month(churn_metrics(states, TODAY))
    assert len(out) == 12
    assert {m.month: row[:3] for m, row in out.items()} == {
        1: (2, 0, 0), 2: (2, 0, 0), 3: (2, 0, 0), 4: (3, 0, 0), 5: (3, 0, 0), 6: (3, 1, 0),
        7: (2, 0, 0), 8: (2, 1, 1), 9: (2, 0, 0), 10: (4, 2, 1), 11: (3, 0, 0), 12: (3, 0, 0),
    }
    assert out[d("2023-10-01")][3:] == (50.0, 99.98)
    assert by_month(churn_denominator(states, TODAY)) == {m: row[:1] for m, row in out.items()}
    assert by_month(churn_numerator(states))[d("2024-01-01")] == (1, 0)


def test_empty_months_have_no_rate(spark):
    out = by_month(churn_metrics(lifecycle(spark, S(1, 1, "2023-11-05")), TODAY))
    assert out[d("2023-11-01")] == (0, 0, 0, None, None)
    assert out[d("2023-12-01")] == (1, 0, 0, 0.0, 0.0)


def test_no_subscriptions_at_all(spark):
    out = by_month(churn_metrics(lifecycle(spark, S(1, 1, None)), TODAY))
    assert len(out) == 12 and set(out.values()) == {(0, 0, 0, None, None)}


def test_any_number_of_months_in_one_plan(spark):
    states = lifecycle(spark, S(1, 1, "1980-03-01"), cancelled(2, "1990-01-05", "2001-06-01"), cancelled(3, "1960-01-01", "1970-01-01"))
    plans = [churn_metrics(states, TODAY, months=m)._jdf.queryExecution().executedPlan().toString() for m in (12, 600)]
    assert len(plans[0].splitlines()) == len(plans[1].splitlines())
    out = by_month(churn_metrics(states, TODAY, months=600))
    assert len(out) == 600 and out[d("1974-01-01")][:3] == (0, 0, 0)
    assert out[d("2001-06-01")][:3] == (2, 1, 0) and out[d("2001-07-01")][:3] == (1, 0, 0)


def test_an_end_before_the_start_counts_nowhere_but_as_churn(spark):
    out = by_month(churn_metrics(lifecycle(spark, cancelled(1, "2023-05-03", "2023-02-10")), TODAY))
    assert {m.month: row[:3] for m, row in out.items() if any(row[:3])} == {2: (0, 1, 1)}


def test_months_unfolded_from_blocks_are_those_of_the_fact(spark):
    """Spans within a block, over its edges, over many blocks, reversed ones, open ones and repeated rows."""
    days = ["2014-12-31", "2023-12-01", "2023-12-31", "2024-01-01", "2024-01-20", "2024-02-29", None]
    spans = [(i, go, end) for i, (go, end) in enumerate((g, e) for g in days for e in days)]
    given = [(i % 40, 7, "voip", "p", 12, "active", d(g) if g else None, d(e) if e else None, 1.5) for i, g, e in spans]
    schema = (
        "subscription_id long, customer_id long, product_type string, plan string, contract_term_months long, "
        "lifecycle_state string, go_live_date date, cancelled_date date, mrr double"
    )
    lifecycle = spark.createDataFrame(given, schema)
    blocks = facts.monthly_blocks(lifecycle, TODAY)
    plain = facts.subscription_monthly(lifecycle, TODAY)
    assert facts.unfolded(blocks).schema == plain.schema
    assert rows(facts.unfolded(blocks)) == rows(plain)
    assert blocks.count() < plain.count() / 3


def test_stored_months_move_as_blocks(spark, tmp_path):
    """The write shuffles rows of blocks, and the months come behind it; the session's setting is as before."""
    from tidemark.plans import stored

    given = spark.range(2_000).selectExpr(
        "id AS subscription_id", "id % 7 AS customer_id", "'voip' AS product_type", "'p' AS plan", "12L AS contract_term_months",
        "'active' AS lifecycle_state", "date_add(date'2020-01-01', cast(id % 900 as int)) AS go_live_date",
        "CAST(NULL AS date) AS cancelled_date", "1.5D AS mrr",
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    got = stored.monthly_through_table(given, TODAY, str(tmp_path / "t"))
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
    plain = facts.subscription_monthly(given, TODAY)
    assert rows(got.select(plain.columns)) == rows(plain)
    dealt = facts.unfolded(facts.monthly_blocks(given, TODAY).hint("rebalance", "_block"))
    text = dealt._jdf.queryExecution().optimizedPlan().toString()
    above, below = text.split("RebalancePartitions")
    assert "_offset" in above and "_offset" not in below and "_block" in below
