"""Typed, trimmed views of the raw tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import Raw
from tidemark.functions.dates import day, days_between, hours_crossed
from tidemark.operators.dedup import one_row_per_key
from tidemark.operators.snapshot import VERSION_COLUMNS, snapshot

# Key and tracked columns of the two history tables (fixed values). Columns not listed are taken as immutable.
TRACKED = {
    "customers": ("customer_id", ["customer_id", "region", "acquisition_channel", "size_band"]),
    "subscriptions": (
        "subscription_id",
        ["status", "mrr", "cancelled_date", "go_live_date", "contract_term_months"],
    ),
}


def customer_history(current: DataFrame, history: DataFrame | None, loaded_at: datetime) -> DataFrame:
    return snapshot(current, history, *TRACKED["customers"], loaded_at)


def subscription_history(current: DataFrame, history: DataFrame | None, loaded_at: datetime) -> DataFrame:
    return snapshot(current, history, *TRACKED["subscriptions"], loaded_at)


def stage_customers(history: DataFrame, as_of: date) -> DataFrame:
    raw = Raw(history)
    return history.select(
        raw.whole("customer_id"),
        raw.calendar_day("signup_date"),
        raw.text("region"),
        raw.text("acquisition_channel"),
        raw.text("size_band"),
        days_between(F.col("signup_date"), day(as_of)).alias("customer_tenure_days"),
        *VERSION_COLUMNS,
    )


def _subscription_columns(rows: DataFrame) -> DataFrame:
    raw = Raw(rows)
    return rows.select(
        raw.whole("subscription_id"),
        raw.whole("customer_id"),
        raw.text("product_type"),
        raw.text("plan"),
        raw.money("mrr"),
        raw.calendar_day("go_live_date"),
        raw.text("status"),
        raw.calendar_day("cancelled_date"),
        raw.whole("contract_term_months"),
        *VERSION_COLUMNS,
    )


def stage_subscriptions(history: DataFrame, as_of: date) -> DataFrame:
    """One row per subscription: the open version if there is one, else the latest; ties fall by the other columns."""
    newest = [F.col("valid_to").desc_nulls_first(), F.col("valid_from").desc()]
    others = [F.col(c).asc_nulls_last() for c in history.columns if c not in {"subscription_id", *VERSION_COLUMNS}]
    rows = _subscription_columns(one_row_per_key(history, ["subscription_id"], newest + others))
    pending = (F.col("status") == "active") & (F.col("go_live_date") > day(as_of))
    return rows.select(
        *[c for c in rows.columns if c not in VERSION_COLUMNS],
        F.coalesce(pending, F.lit(False)).alias("is_pending_activation_flag"),
        *VERSION_COLUMNS,
    )


def stage_billings(rows: DataFrame) -> DataFrame:
    raw = Raw(rows)
    return rows.select(
        raw.whole("invoice_id"),
        raw.whole("customer_id"),
        raw.calendar_day("period_month"),
        raw.money("amount_due"),
        raw.money("amount_paid"),
        raw.text("status"),
    )


def stage_support_contacts(rows: DataFrame) -> DataFrame:
    raw = Raw(rows)
    return rows.select(
        raw.whole("contact_id"),
        raw.whole("customer_id"),
        raw.moment("created_at"),
        raw.text("channel"),
        raw.text("category"),
        raw.moment("resolved_at"),
        F.col("resolved_at").isNull().alias("is_unresolved_flag"),
        hours_crossed(F.col("created_at"), F.col("resolved_at")).alias("resolution_hours"),
    )


def stage_portal_events(rows: DataFrame) -> DataFrame:
    raw = Raw(rows)
    return rows.select(
        raw.whole("event_id"),
        raw.whole_from_decimal("customer_id"),
        raw.text("event_type"),
        raw.moment("event_timestamp"),
        F.col("customer_id").isNull().alias("is_unattributed_flag"),
    )


def stage_usage_daily(rows: DataFrame) -> DataFrame:
    raw = Raw(rows)
    return rows.select(
        raw.whole("subscription_id"),
        raw.calendar_day("usage_date"),
        raw.whole("call_count"),
        raw.money("call_minutes"),
        raw.whole("concurrent_peak"),
    )
