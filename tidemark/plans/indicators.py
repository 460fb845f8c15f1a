"""Leading indicators: which signals precede churn more often than they occur among retained subscriptions?"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rates import percent, risk_ratio
from tidemark.operators.hot_keys import HOT_ROWS, join_unique
from tidemark.operators.lookback import last_seen_before, rows_with_last_seen, within

# Signal names of the scan (fixed values): mark -> name
CUSTOMER_SIGNALS = {
    "complaint": "support_complaint_60d",
    "ticket_open": "portal_support_ticket_open_60d",
    "technical_fault": "technical_fault_60d",
    "billing": "billing_unpaid_or_partpaid_60d",
}
USAGE_SIGNALS = {
    "usage_drop": "usage_minutes_drop_50pct_30d",
    "peak": "concurrent_peak_top_decile_60d",
}


def support_sightings(support: DataFrame) -> DataFrame:
    category = F.col("category")
    return support.where(category.isin("complaint", "technical_fault")).select(
        "customer_id",
        F.to_date("created_at").alias("seen_on"),
        (category == "complaint").alias("complaint"),
        (category == "technical_fault").alias("technical_fault"),
    )


def portal_sightings(portal: DataFrame) -> DataFrame:
    return portal.where(F.col("event_type") == "support_ticket_open").select(
        "customer_id", F.to_date("event_timestamp").alias("seen_on"), F.lit(True).alias("ticket_open")
    )


def billing_sightings(billings: DataFrame) -> DataFrame:
    return billings.where(F.col("status").isin("unpaid", "part_paid")).select(
        "customer_id", F.col("period_month").alias("seen_on"), F.lit(True).alias("billing")
    )


def customer_signal(
    base: DataFrame, sightings: DataFrame, mark: str, window_days: int = 60, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(subscription_id) of the base subscriptions whose customer shows ``mark`` in the days before the reference date."""
    anchors = base.select("subscription_id", "customer_id", "reference_date")
    seen = rows_with_last_seen(anchors, sightings.where(mark), "customer_id", "reference_date", [mark], hot_rows)
    return seen.where(within(mark, "reference_date", window_days)).select("subscription_id")


def _usage_days(usage: DataFrame) -> DataFrame:
    """Days without calls report a default peak and do not count."""
    return usage.select(
        "subscription_id",
        "usage_date",
        F.col("call_minutes").alias("minutes"),
        F.when(F.col("call_count") > 0, F.col("concurrent_peak")).alias("peak"),
    )


def daily_usage(usage: DataFrame) -> DataFrame:
    """(subscription_id, usage_date, minutes, peak): usage as the signals need it, one row per subscription and day.

    To be stored, in buckets of subscription_id: no subscription has more rows than there are days.
    """
    days = _usage_days(usage.where(F.col("subscription_id").isNotNull() & F.col("usage_date").isNotNull()))
    return days.groupBy("subscription_id", "usage_date").agg(F.sum("minutes").alias("minutes"), F.max("peak").alias("peak"))


def usage_flags(
    base: DataFrame,
    usage: DataFrame,
    window_days: int = 60,
    recent_days: int = 30,
    drop_threshold: float | Decimal = -0.5,
    peak_threshold: int = 8,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per base subscription with usage in its window: did call minutes drop between the halves, did concurrency peak?

    Usage, the largest table, is shuffled once, to the base row of its subscription; where AQE measures the base as small
    it is broadcast instead. Rows of a subscription with more than ``hot_rows`` of them are salted.
    ``drop_threshold`` is exact: a decimal with any number of digits up to 18. ``usage`` may be the table of ``daily_usage``
    instead: it has no hot keys, takes the plain join, and where it and the base are stored in buckets shuffles nothing.
    """
    wanted = base.select("subscription_id", "is_churned", "reference_date")
    if "minutes" in usage.columns:
        joined = usage.join(wanted, "subscription_id")
    else:
        joined = join_unique(_usage_days(usage), wanted, ["subscription_id"], "inner", hot_rows)
    reference, used = F.col("reference_date"), F.col("usage_date")
    is_recent = used >= F.date_sub(reference, recent_days)
    sums = (
        joined.where((used < reference) & (used >= F.date_sub(reference, window_days)))
        .groupBy("subscription_id", "is_churned")
        .agg(
            F.coalesce(F.sum(F.when(is_recent, F.col("minutes"))), F.lit(0)).alias("recent"),
            F.coalesce(F.sum(F.when(~is_recent, F.col("minutes"))), F.lit(0)).alias("prior"),
            F.max("peak").alias("peak"),
        )
    )
    # compared as a product: exact in decimals, and no division by zero
    threshold = F.lit(Decimal(str(drop_threshold)))
    dropped = (F.col("prior") > 0) & (F.col("recent") - F.col("prior") < F.col("prior") * threshold)
    return sums.select(
        "subscription_id",
        "is_churned",
        dropped.alias("usage_drop"),
        F.coalesce(F.col("peak") >= peak_threshold, F.lit(False)).alias("peak"),
    )


def _counts() -> list[Column]:
    """One subscription as a count of churned and a count of active ones."""
    return [F.when(F.col("is_churned"), one).otherwise(1 - one).alias(name) for name, one in (("churned", 1), ("active", 0))]


def leading_indicator_scan(
    base: DataFrame,
    support: DataFrame,
    portal: DataFrame,
    billings: DataFrame,
    usage: DataFrame,
    window_days: int = 60,
    recent_days: int = 30,
    drop_threshold: float | Decimal = -0.5,
    peak_threshold: int = 8,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Six signals: how many churned and how many retained subscriptions show them, and the ratio of the two rates.

    The four customer signals need no join to the base: its rows enter as counts per customer and reference date.
    One aggregate counts all signals. ``base`` has one row per subscription.
    """
    sightings = reduce(
        lambda a, b: a.unionByName(b, True),
        [support_sightings(support), portal_sightings(portal), billing_sightings(billings)],
    )
    anchors = base.select("customer_id", "reference_date", *_counts())
    seen = last_seen_before(
        anchors, sightings, "customer_id", "reference_date", ["churned", "active"], list(CUSTOMER_SIGNALS)
    ).select(
        "churned",
        "active",
        F.col("churned").alias("all_churned"),
        F.col("active").alias("all_active"),
        *[within(m, "reference_date", window_days).alias(m) for m in CUSTOMER_SIGNALS],
    )
    # usage rows add to their signals only; the totals come from the anchors
    used = usage_flags(
        base, usage, window_days, recent_days, drop_threshold, peak_threshold, hot_rows
    ).select(*_counts(), *USAGE_SIGNALS)

    def total(column: Column, name: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).alias(name)

    signals = {**CUSTOMER_SIGNALS, **USAGE_SIGNALS}
    sums = used.unionByName(seen, allowMissingColumns=True).agg(
        *[total(F.col(f"all_{group}"), group) for group in ("churned", "active")],
        *[total(F.when(F.col(m), F.col(group)), f"{group}_{m}") for m in signals for group in ("churned", "active")],
    )
    rows = [
        F.struct(
            F.lit(name).alias("signal_name"),
            F.col("churned").alias("churned_total"),
            F.col(f"churned_{mark}").alias("churned_with_signal"),
            F.col("active").alias("active_total"),
            F.col(f"active_{mark}").alias("active_with_signal"),
        )
        for mark, name in signals.items()
    ]
    c = F.col
    return (
        sums.select(F.inline(F.array(*rows)))
        .select(
            "signal_name",
            "churned_total",
            "churned_with_signal",
            percent(c("churned_with_signal"), c("churned_total"), 1).alias("churned_rate_pct"),
            "active_total",
            "active_with_signal",
            percent(c("active_with_signal"), c("active_total"), 1).alias("active_rate_pct"),
            risk_ratio(
                c("churned_with_signal"), c("churned_total"), c("active_with_signal"), c("active_total")
            ).alias("risk_ratio"),
        )
        .orderBy(c("risk_ratio").desc_nulls_first())
    )
