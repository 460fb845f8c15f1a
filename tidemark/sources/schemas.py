"""Declared schemas of the six raw tables, as DDL. Nothing is inferred on read."""

RAW: dict[str, str] = {
    "customers": "customer_id bigint, signup_date date, region string, acquisition_channel string, size_band string",
    "subscriptions": (
        "subscription_id bigint, customer_id bigint, product_type string, plan string, mrr double, "
        "go_live_date date, status string, cancelled_date date, contract_term_months bigint"
    ),
    "billings": (
        "invoice_id bigint, customer_id bigint, period_month date, amount_due double, amount_paid double, status string"
    ),
    "support_contacts": (
        "contact_id bigint, customer_id bigint, created_at timestamp_ntz, channel string, category string, "
        "resolved_at timestamp_ntz"
    ),
    # customer_id arrives as decimal text and is null where an event is not attributed
    "portal_events": "event_id bigint, customer_id string, event_type string, event_timestamp timestamp_ntz",
    "usage_daily": (
        "subscription_id bigint, usage_date date, call_count bigint, call_minutes double, concurrent_peak bigint"
    ),
}
