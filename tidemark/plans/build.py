"""The whole build: histories, staging views, lifecycle, marts."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.snapshot import load
from tidemark.plans import facts, indicators, lifecycle, staging, stored
from tidemark.sources.layout import publish_buckets
from tidemark.sources.tables import (
    history_schema,
    is_stored,
    open_versions,
    publish_history,
    publish_table,
    publish_view,
    read_history,
)


def refresh_histories(spark: SparkSession, raw: dict[str, DataFrame], root: str, loaded_at: datetime) -> dict[str, DataFrame]:
    """Load the current customers and subscriptions into their histories; returns them whole.

    A load that is stored already is not repeated, so a run that failed halfway can be started again.
    """
    histories = {}
    for name, (key, check_cols) in staging.TRACKED.items():
        path, schema = f"{root}/snapshots/{name}", history_schema(raw[name].schema)
        if not is_stored(spark, path, loaded_at):
            publish_history(load(raw[name], open_versions(spark, path, schema), key, check_cols, loaded_at), path, loaded_at)
        histories[name] = read_history(spark, path, schema)
    return histories


def stage(raw: dict[str, DataFrame], histories: dict[str, DataFrame], as_of: date) -> dict[str, DataFrame]:
    """The six staged tables; lazy, nothing is computed."""
    return {
        "customers": staging.stage_customers(histories["customers"], as_of),
        "subscriptions": staging.stage_subscriptions(histories["subscriptions"], as_of),
        "billings": staging.stage_billings(raw["billings"]),
        "support_contacts": staging.stage_support_contacts(raw["support_contacts"]),
        "portal_events": staging.stage_portal_events(raw["portal_events"]),
        "usage_daily": staging.stage_usage_daily(raw["usage_daily"]),
    }


def build(
    spark: SparkSession, raw: dict[str, DataFrame], root: str, as_of: date, loaded_at: datetime, buckets: int | None = None
) -> dict[str, DataFrame]:
    """Refresh everything under ``root``, a folder all executors reach, and return the marts as read back from it.

    The lifecycle is written once: three marts and the base read it, and a lost executor costs none of them a
    second run of its windows. With ``buckets`` the base and the daily usage are stored too, in so many buckets of the
    subscription: the scan then joins them without a shuffle, and so does any later scan of the same tables.
    """
    histories = refresh_histories(spark, raw, root, loaded_at)
    staged = stage(raw, histories, as_of)
    for name, df in staged.items():
        publish_view(df, f"stg_{name}")

    states = publish_table(
        lifecycle.subscription_lifecycle(staged["subscriptions"]),
        f"{root}/intermediate/subscription_lifecycle",
    )
    publish_view(states, "int_subscription_lifecycle")
    base = publish_view(lifecycle.indicator_base(states, as_of), "int_leading_indicator_base")

    usage = staged["usage_daily"]
    if buckets:
        run = uuid.uuid4().hex
        place, key = f"{root}/buckets/{run}", "subscription_id"
        base = publish_buckets(base, f"base_{run}", f"{place}/base", key, buckets)
        usage = publish_buckets(indicators.daily_usage(usage), f"usage_{run}", f"{place}/usage", key, buckets, ("usage_date",))

    marts = {
        "subscription_monthly": stored.publish_monthly(states, as_of, f"{root}/marts/subscription_monthly"),
        "churn_metrics": publish_table(facts.churn_metrics(states, as_of), f"{root}/marts/churn_metrics"),
        "leading_indicator_scan": publish_table(
            indicators.leading_indicator_scan(
                base, staged["support_contacts"], staged["portal_events"], staged["billings"], usage
            ),
            f"{root}/marts/leading_indicator_scan",
        ),
    }
    return marts
