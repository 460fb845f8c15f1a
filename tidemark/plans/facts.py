"""Monthly subscription fact and churn metrics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import day, month_start, months_apart
from tidemark.functions.rates import compounded_percent, percent
from tidemark.plans.lifecycle import LIVE_STATES, live_subscriptions


MONTHLY = ["subscription_id", "customer_id", "product_type", "plan", "contract_term_months", "lifecycle_state"]


def subscription_monthly(lifecycle: DataFrame, as_of: date) -> DataFrame:
    """One row per live subscription and month, from go-live up to and including the month of cancellation, or today's.

    Each row unfolds its own months in place: no calendar table, no range join, no shuffle.
    """
    length = months_apart(F.col("go_live_date"), F.coalesce("cancelled_date", day(as_of)))
    # the test is part of the expression, as sequence counts downwards for a reversed span
    offsets = F.when(length >= 0, F.sequence(F.lit(0), length))
    return (
        live_subscriptions(lifecycle)
        .select(*MONTHLY, month_start(F.col("go_live_date")).alias("_first"), F.explode(offsets).alias("_offset"), "mrr")
        .select(*MONTHLY, F.add_months("_first", F.col("_offset")).alias("activity_month"), "mrr")
    )


BLOCK = 4  # months of one subscription that move as one row


def monthly_blocks(lifecycle: DataFrame, as_of: date) -> DataFrame:
    """``subscription_monthly`` before its months are unfolded: a row per live subscription and block of BLOCK calendar months.

    ``_block`` numbers the blocks; a row has the months from ``_first`` on, ``_length`` of them after it, that lie in its block.
    """
    length = months_apart(F.col("go_live_date"), F.coalesce("cancelled_date", day(as_of)))
    blocks = F.sequence(F.floor(_month_number("_first") / BLOCK), F.floor((_month_number("_first") + F.col("_length")) / BLOCK))
    return (
        live_subscriptions(lifecycle)
        .select(*MONTHLY, month_start(F.col("go_live_date")).alias("_first"), length.cast("int").alias("_length"), "mrr")
        .select("*", F.explode(F.when(F.col("_length") >= 0, blocks).cast("array<int>")).alias("_block"))
    )


def _month_number(column: str) -> Column:
    return F.year(column) * 12 + F.month(column) - 1


def unfolded(blocks: DataFrame) -> DataFrame:
    """The rows of ``subscription_monthly`` that those of ``monthly_blocks`` stand for."""
    ahead = F.col("_block") * BLOCK - _month_number("_first")  # months from the first one to the block
    offsets = F.sequence(F.greatest(ahead, F.lit(0)), F.least(ahead + (BLOCK - 1), F.col("_length")))
    return blocks.select("*", F.explode(offsets).alias("_offset")).select(
        *MONTHLY, F.add_months("_first", F.col("_offset")).alias("activity_month"), "mrr"
    )


def month_changes(as_of: date, months: int, early_life_days: int) -> Column:
    """What one subscription changes in the trailing months: an array of (churn_month, live, churned, early), nulls included.

    It adds one live subscription from the first month that starts after its go-live, and takes one away after the month
    in which it ends; changes ahead of the first month count towards it. Months from ``as_of`` on are to be left out.
    """
    first = F.add_months(month_start(day(as_of)), -months)
    state, go_live, ended = F.col("lifecycle_state"), F.col("go_live_date"), F.col("cancelled_date")
    churned = state == "voluntary_cancellation"
    early = F.datediff(ended, go_live) <= early_life_days
    enters = F.greatest(F.add_months(month_start(go_live), 1), first)
    left_in = month_start(ended)
    leaves = F.greatest(F.add_months(left_in, 1), first)
    is_counted = state.isin(*LIVE_STATES) & go_live.isNotNull() & (ended.isNull() | (leaves > enters))

    def change(month: Column, live: int | Column, churned: int | Column, early: int | Column) -> Column:
        values = {"live": live, "churned": churned, "early": early}
        return F.struct(month.alias("churn_month"), *[F.lit(v).cast("long").alias(k) for k, v in values.items()])

    return F.array(
        F.when(is_counted, change(enters, 1, 0, 0)),
        F.when(is_counted & ended.isNotNull(), change(leaves, -1, 0, 0)),
        F.when(churned & (left_in >= first), change(left_in, 0, 1, F.when(early, 1).otherwise(0))),
    )


def trailing_months(spark: SparkSession, as_of: date, months: int) -> DataFrame:
    """(churn_month): the full months before ``as_of``."""
    this_month = month_start(day(as_of))
    span = F.sequence(F.add_months(this_month, -months), F.add_months(this_month, -1), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(span).alias("churn_month"))


def _trailing_counts(lifecycle: DataFrame, as_of: date, months: int, early_life_days: int) -> DataFrame:
    """One row per full month before ``as_of``: live at its start, churned in it, churned early.

    A sweep over the months: a running sum over their changes counts the live ones. At most ``months`` rows leave a task, and
    the plan is the same for any number of months. Months without subscriptions come from the calendar, which is laid under
    the changes.
    """
    counts = ["live", "churned", "early"]
    calendar = trailing_months(lifecycle.sparkSession, as_of, months).select("churn_month", *[F.lit(0).cast("long").alias(c) for c in counts])
    by_month = (
        lifecycle.select(F.inline(month_changes(as_of, months, early_life_days)))
        .where(F.col("churn_month") < month_start(day(as_of)))
        .unionByName(calendar)
        .groupBy("churn_month")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )
    so_far = Window.orderBy("churn_month").rowsBetween(Window.unboundedPreceding, 0)  # one row per month
    return by_month.select(
        "churn_month",
        F.sum("live").over(so_far).alias("active_start_of_month"),
        F.col("churned").alias("churned_subs"),
        F.col("early").alias("early_life_churned_subs"),
    )


def churn_denominator(lifecycle: DataFrame, as_of: date, months: int = 12) -> DataFrame:
    """(churn_month, active_start_of_month), months without any subscription included."""
    return _trailing_counts(lifecycle, as_of, months, 0).select("churn_month", "active_start_of_month")


def churn_numerator(lifecycle: DataFrame, early_life_days: int = 30) -> DataFrame:
    """(churn_month, churned_subs, early_life_churned_subs) over all months; early life is a breakout, not a deduction."""
    tenure = F.datediff("cancelled_date", "go_live_date")
    return (
        lifecycle.where(F.col("lifecycle_state") == "voluntary_cancellation")
        .groupBy(month_start(F.col("cancelled_date")).alias("churn_month"))
        .agg(
            F.count("*").alias("churned_subs"),
            F.count(F.when(tenure <= early_life_days, True)).alias("early_life_churned_subs"),
        )
    )


def churn_metrics(lifecycle: DataFrame, as_of: date, months: int = 12, early_life_days: int = 30) -> DataFrame:
    """Voluntary churn per full trailing month, as monthly and as compounded annual rate."""
    churned, live = F.col("churned_subs"), F.col("active_start_of_month")
    return (
        _trailing_counts(lifecycle, as_of, months, early_life_days)
        .select(
            "*",
            percent(churned, live, 2).alias("monthly_churn_rate_pct"),
            compounded_percent(churned, live, 12).alias("annualised_churn_rate_pct"),
        )
        .orderBy("churn_month")
    )
