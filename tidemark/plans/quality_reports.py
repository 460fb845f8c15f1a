"""The data-quality profile of the raw tables, and the listings used to look into single entities."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day
from tidemark.operators.hot_keys import join_unique
from tidemark.operators.quality import (
    counts,
    duplicate_rows,
    frequencies,
    key_uniqueness,
    null_checks,
    orphans,
    ranges,
    repeated,
    violations,
)

Tables = dict[str, DataFrame]
Checks = dict[str, Column]


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(raw: Tables, names: list[str]) -> DataFrame:
    return _stack(
        [raw[t].agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t in names]
    )


def full_row_duplicates(raw: Tables) -> DataFrame:
    names = ["subscriptions", "billings", "support_contacts", "portal_events", "usage_daily"]
    return _stack([duplicate_rows(raw[t], t) for t in names])


def duplicate_listing(df: DataFrame) -> DataFrame:
    return repeated(df, df.columns)


def key_checks(raw: Tables) -> DataFrame:
    keys = {
        "customers": ["customer_id"],
        "billings": ["invoice_id"],
        "portal_events": ["event_id"],
        "usage_daily": ["subscription_id", "usage_date"],
    }
    return _stack([key_uniqueness(raw[t], t, columns) for t, columns in keys.items()])


# Columns that must not be null, per table
REQUIRED = {
    "subscriptions": ["subscription_id", "customer_id"],
    "billings": ["customer_id", "period_month"],
    "support_contacts": ["contact_id", "customer_id", "created_at"],
    "portal_events": ["event_id", "customer_id", "event_timestamp"],
    "usage_daily": ["subscription_id", "usage_date"],
}


def null_keys(raw: Tables) -> DataFrame:
    return _stack([violations(raw[t], t, null_checks(columns)) for t, columns in REQUIRED.items()])


def domains(staged: Tables) -> DataFrame:
    columns = {
        "subscriptions": ["status", "product_type", "plan"],
        "billings": ["status"],
        "support_contacts": ["category"],
        "portal_events": ["event_type"],
    }
    return _stack([frequencies(staged[t], t, c) for t, c in columns.items()])


def subscription_rules(as_of: date) -> Checks:
    status, go_live, cancelled = F.trim("status"), F.col("go_live_date"), F.col("cancelled_date")
    return {
        "doa_with_go_live_date": (status == "doa") & go_live.isNotNull(),
        "doa_cancelled_in_future": (status == "doa") & (cancelled > day(as_of)),
        "active_with_cancelled_date": (status == "active") & cancelled.isNotNull(),
        "active_without_go_live_date": (status == "active") & go_live.isNull(),
        "active_with_future_go_live": (status == "active") & (go_live > day(as_of)),
    }


def billing_rules() -> Checks:
    status, due, paid = F.trim("status"), F.col("amount_due"), F.col("amount_paid")
    return {
        "paid_exceeds_due": paid > due,
        "paid_with_open_amount": (status == "paid") & (due != paid),
        "unpaid_with_payment": (status == "unpaid") & (paid != 0),
        "part_paid_in_full_or_not_at_all": (status == "part_paid") & ((paid == 0) | (due == paid)),
    }


def support_rules() -> Checks:
    created, resolved = F.col("created_at"), F.col("resolved_at")
    return {"open_ticket": resolved.isNull(), "resolved_not_after_created": resolved <= created}


def usage_rules() -> Checks:
    measures = ["call_count", "call_minutes", "concurrent_peak"]
    return {**null_checks(measures), **{f"{m}_is_negative": F.col(m) < 0 for m in measures}}


def profile(raw: Tables, as_of: date) -> DataFrame:
    """All null checks and rules of every table, each table read once."""
    rules = {
        "subscriptions": subscription_rules(as_of),
        "billings": billing_rules(),
        "support_contacts": support_rules(),
        "portal_events": {},
        "usage_daily": usage_rules(),
    }
    return _stack([violations(raw[t], t, {**null_checks(REQUIRED[t]), **rules[t]}) for t in rules])


def value_ranges(staged: Tables) -> DataFrame:
    return _stack(
        [
            ranges(staged["billings"], "billings", days=["period_month"], amounts=["amount_due", "amount_paid"]),
            ranges(staged["support_contacts"], "support_contacts", moments=["created_at", "resolved_at"]),
            ranges(staged["portal_events"], "portal_events", moments=["event_timestamp"]),
            ranges(staged["usage_daily"], "usage_daily", days=["usage_date"]),
        ]
    )


def attribution(portal: DataFrame) -> DataFrame:
    return counts(portal, ["is_unattributed_flag"])


def signup_trend(customers: DataFrame) -> DataFrame:
    """(period_kind, period, cnt): sign-ups per day, month of the year, and year-month, in one scan."""
    signup = F.col("signup_date")
    periods = {
        "day": signup.cast("string"),
        "month_of_year": F.month(signup).cast("string"),
        "year_month": F.concat(F.year(signup).cast("string"), F.lit("-"), F.lpad(F.month(signup).cast("string"), 2, "0")),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("period_kind"), v.alias("period")) for k, v in periods.items()])
    grouped = customers.select(F.inline(rows)).groupBy("period_kind", "period").agg(F.count("*").alias("cnt"))
    return grouped.orderBy("period_kind", "period")


def multi_subscription_customers(subscriptions: DataFrame) -> DataFrame:
    return counts(subscriptions, ["customer_id"]).where(F.col("cnt") > 1)


def signal_population(staged: Tables) -> DataFrame:
    """Rows per signal before any window, one scan per source."""
    support, portal = staged["support_contacts"], staged["portal_events"]
    return _stack(
        [
            violations(
                support,
                "support_contacts",
                {"complaint": F.col("category") == "complaint", "technical_fault": F.col("category") == "technical_fault"},
            ),
            violations(portal, "portal_events", {"support_ticket_open": F.col("event_type") == "support_ticket_open"}),
            violations(
                staged["billings"], "billings", {"unpaid_or_part_paid": F.col("status").isin("unpaid", "part_paid")}
            ),
            violations(staged["usage_daily"], "usage_daily", {"concurrent_peak_8_or_more": F.col("concurrent_peak") >= 8}),
        ]
    ).withColumnsRenamed({"check_name": "signal", "n_violations": "n_signal"})


def referential_integrity(staged: Tables) -> DataFrame:
    children = ["subscriptions", "billings", "support_contacts", "portal_events"]
    return orphans({t: staged[t] for t in children}, staged["customers"], "customers", "customer_id").unionByName(
        orphans({"usage_daily": staged["usage_daily"]}, staged["subscriptions"], "subscriptions", "subscription_id")
    )


def entity_rows(df: DataFrame, customer_id: int, order: tuple[str, ...], product_type: str | None = None) -> DataFrame:
    """All rows of one customer, of one product if given, ordered by the given columns (nulls last)."""
    rows = df.where(F.col("customer_id") == customer_id)
    if product_type is not None:
        rows = rows.where(F.col("product_type") == product_type)
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in order])


def largest_customers(subscriptions: DataFrame) -> DataFrame:
    """(customer_id): the customers with the most subscriptions, all of them if several share the highest count."""
    counts = subscriptions.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.count("*").alias("n"))
    highest = counts.agg(F.max("n").alias("n"))  # one row
    return counts.join(F.broadcast(highest), "n", "left_semi").select("customer_id")


def timelines(df: DataFrame, customers: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """All rows of the listed customers, ordered by customer and the given columns (nulls last)."""
    rows = join_unique(df, customers, ["customer_id"], "left_semi")
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in ("customer_id", *order)])
