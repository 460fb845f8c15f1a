from __future__ import annotations

from datetime import date, datetime


def d(text: str | None) -> date | None:
    return date.fromisoformat(text) if text else None


def ts(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def rows(df, *columns: str) -> list[tuple]:
    """Collected rows of the given columns, sorted, nulls last."""
    picked = [tuple(r) for r in df.select(*columns or df.columns).collect()]
    return sorted(picked, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


SUBSCRIPTION = (
    "subscription_id bigint, customer_id bigint, product_type string, plan string, mrr decimal(10,2), go_live_date date, "
    "status string, cancelled_date date, contract_term_months bigint, is_pending_activation_flag boolean"
)


def subscription(
    sub: int, customer: int | None = 1, go_live: str | None = "2023-01-10", status="active", cancelled: str | None = None,
    product: str | None = "voip", pending=False,
) -> tuple:
    return (sub, customer, product, "p", None, d(go_live), status, d(cancelled), 12, pending)


def subscriptions(spark, *given: tuple):
    return spark.createDataFrame(list(given), SUBSCRIPTION)
