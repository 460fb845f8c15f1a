"""Datasets behind the churn dashboard."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import day, days_between, month_start
from tidemark.functions.rates import compounded_percent
from tidemark.operators.lookback import last_seen_before, within
from tidemark.operators.quality import counts
from tidemark.plans import facts
from tidemark.plans.indicators import billing_sightings
from tidemark.plans.lifecycle import LIVE_STATES, live_subscriptions


def at_risk_customers(
    lifecycle: DataFrame, billings: DataFrame, customers: DataFrame, as_of: date, window_days: int = 60
) -> DataFrame:
    """Customers with a retained subscription that shows the billing signal: region, revenue of those subscriptions,
    days since the last open invoice of the window."""
    retained = live_subscriptions(lifecycle).where(F.col("lifecycle_state") != "voluntary_cancellation")
    anchors = retained.select(
        "customer_id",
        F.coalesce("cancelled_date", day(as_of)).alias("reference_date"),
        "mrr",
        F.lit(1).alias("subscriptions"),
    )
    seen = last_seen_before(
        anchors, billing_sightings(billings), "customer_id", "reference_date", ["mrr", "subscriptions"], ["billing"]
    )
    at_risk = (
        seen.where(within("billing", "reference_date", window_days))
        .groupBy("customer_id")
        .agg(
            F.sum("mrr").alias("mrr"),
            F.sum("subscriptions").alias("at_risk_subscriptions"),
            F.max("last_billing").alias("last_unpaid"),
        )
    )
    regions = (
        customers.where(F.col("valid_to").isNull()).groupBy("customer_id").agg(F.min("region").alias("region"))
    )
    return at_risk.join(regions, "customer_id", "left").select(
        "customer_id",
        "region",
        F.col("mrr").cast("decimal(18,2)").alias("mrr"),
        "at_risk_subscriptions",
        days_between(F.col("last_unpaid"), day(as_of)).alias("days_since_last_unpaid_invoice"),
    )


def kpis(
    lifecycle: DataFrame, billings: DataFrame, as_of: date, months: int = 12, early_life_days: int = 30, window_days: int = 60
) -> DataFrame:
    """(kpi_name, kpi_value): mean annualised churn of the trailing months, active subscriptions, customers at risk.

    The lifecycle is read once. Each subscription enters as what it changes in the months, as a count of active ones and, if
    retained, as a reference day of its customer; open invoices enter as days of their customers. All are rolled up by group
    and day, and one pass in the order of days gives the live subscriptions per month and the last open invoice before
    each reference day.
    """
    state = F.col("lifecycle_state")
    retained = state.isin(*LIVE_STATES) & F.col("go_live_date").isNotNull() & (state != "voluntary_cancellation")

    def entry(kind: str, key: Column, on: Column, **values: Column) -> Column:
        known = {"live": F.lit(0), "churned": F.lit(0), "n": F.lit(0), **values}
        counts = [v.cast("long").alias(k) for k, v in known.items()]
        return F.struct(F.lit(kind).alias("kind"), key.cast("long").alias("key"), on.cast("date").alias("day"), *counts)

    none, one = F.lit(None), F.lit(1)
    changes = F.filter(facts.month_changes(as_of, months, early_life_days), lambda c: c.isNotNull())
    in_months = F.transform(changes, lambda c: entry("month", none, c["churn_month"], live=c["live"], churned=c["churned"]))
    others = F.array(
        F.when(state == "active", entry("active", none, none, n=one)),
        F.when(retained, entry("customer", F.col("customer_id"), F.coalesce("cancelled_date", day(as_of)), n=one)),
    )
    calendar = facts.trailing_months(lifecycle.sparkSession, as_of, months)
    open_invoices = billing_sightings(billings).where("customer_id IS NOT NULL AND seen_on IS NOT NULL")
    rows = (
        lifecycle.select(F.inline(F.concat(in_months, others)))
        .where((F.col("kind") != "month") | (F.col("day") < month_start(day(as_of))))
        .unionByName(calendar.select(entry("month", none, F.col("churn_month")).alias("e")).select("e.*"))
        .withColumn("seen", F.lit(None).cast("date"))
        .unionByName(
            open_invoices.select(entry("customer", F.col("customer_id"), F.col("seen_on")).alias("e"), F.col("seen_on").alias("seen"))
            .select("e.*", "seen")
        )
    )
    sums = [F.sum(c).alias(c) for c in ("live", "churned", "n")]
    rolled = rows.where("kind IS NOT NULL").groupBy("kind", "key", "day").agg(*sums, F.max("seen").alias("seen"))
    in_order = Window.partitionBy("kind", "key").orderBy("day")
    live = F.sum("live").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    last_seen = F.max("seen").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    by_day = rolled.select("*", live.alias("live_now"), last_seen.alias("last_seen")).select(
        "kind",
        "key",
        "n",
        F.when(F.col("kind") == "month", compounded_percent(F.col("churned"), F.col("live_now"), 12)).alias("rate"),
        ((F.col("n") > 0) & (F.col("last_seen") >= F.date_sub("day", window_days))).alias("risky"),
    )
    by_key = by_day.groupBy("kind", "key").agg(
        F.sum(F.round(F.col("rate") * 100).cast("bigint")).alias("hundredths"),
        F.count("rate").alias("n_rates"),
        F.sum("n").alias("n"),
        F.max("risky").alias("risky"),
    )
    totals = by_key.agg(
        (F.sum("hundredths").cast("double") / (F.sum("n_rates") * 100)).alias("churn"),
        F.coalesce(F.sum(F.when(F.col("kind") == "active", F.col("n"))), F.lit(0)).alias("active"),
        F.count(F.when((F.col("kind") == "customer") & F.col("risky"), True)).alias("at_risk"),
    )
    names = {"mean_annualised_churn_rate_pct": "churn", "active_subscriptions": "active", "at_risk_customers": "at_risk"}
    return totals.select(
        F.inline(
            F.array(*[F.struct(F.lit(n).alias("kpi_name"), F.col(c).cast("double").alias("kpi_value")) for n, c in names.items()])
        )
    )


def churn_trend(churn: DataFrame) -> DataFrame:
    return churn.select("churn_month", "monthly_churn_rate_pct", "annualised_churn_rate_pct")


def risk_ratios(scan: DataFrame) -> DataFrame:
    return scan.select("signal_name", "risk_ratio")


def state_distribution(rows: DataFrame) -> DataFrame:
    """(lifecycle_state, cnt): of the lifecycle, or of the months of the monthly fact."""
    return counts(rows, ["lifecycle_state"])
