"""The six raw tables of a subscription business, derived from the star-schema test data.

Order = subscription, customer = customer, line item = invoice and usage, event = support contact and portal event.
Rules and expected counts are in FIXTURES.md. Some texts are padded on purpose.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = date(2024, 1, 20)
FIRST_LOAD = datetime(2024, 1, 18)
SECOND_LOAD = datetime(2024, 1, 19)


# Columns used of the given tables (fixed values)
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(GIVEN[table]).parquet(f"{sf_dir}/{table}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    first_order = (
        _read(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min(F.to_date("o_orderdate")).alias("first_order"))
    )
    # nation and region are fixed dimensions of 25 and 5 rows
    places = _read(spark, sf_dir, "nation").join(
        F.broadcast(_read(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    balance = F.col("c_acctbal")
    return (
        _read(spark, sf_dir, "customer")
        .join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(first_order, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.add_months("first_order", 269).alias("signup_date"),
            F.concat("r_name", F.lit(" ")).alias("region"),
            F.col("c_mktsegment").alias("acquisition_channel"),
            F.when(balance < 2000, "small").when(balance < 6000, "medium").otherwise("large").alias("size_band"),
        )
    )


def distinct_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    go_live = F.add_months(F.to_date("o_orderdate"), 270)
    ends = F.date_add(go_live, (5 + (key * 37) % 700).cast("int"))
    status = (
        F.when(key % 25 == 0, "fraud")
        .when(key % 17 == 0, "doa")
        .when((F.col("o_orderstatus") == "F") & (ends <= F.lit(AS_OF)), " cancelled")
        .otherwise("active ")
    )
    priority = F.col("o_orderpriority")
    return _read(spark, sf_dir, "orders").select(
        key.alias("subscription_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), "voip")
        .when(priority == "3-MEDIUM", "mobile")
        .otherwise("broadband")
        .alias("product_type"),
        F.concat(F.lit(" plan_"), (key % 8).cast("string"), F.lit(" ")).alias("plan"),
        (20 + (key * 13) % 400 + F.lit(0.5)).cast("double").alias("mrr"),
        F.when(status != "doa", go_live).alias("go_live_date"),
        status.alias("status"),
        F.when(status != "active ", ends).alias("cancelled_date"),
        (12 * (1 + key % 3)).cast("bigint").alias("contract_term_months"),
    )


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the source delivers them: some rows come twice."""
    copies = F.when(F.col("subscription_id") % 26 == 1, 2).otherwise(1)
    return (
        distinct_subscriptions(spark, sf_dir)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        .drop("copy")
    )


def billings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    months_back = ((F.col("l_orderkey") * 7 + F.col("l_partkey")) % 48).cast("int")
    open_amount = F.col("l_partkey") % 3 == 0
    status = (
        F.when(open_amount & (F.col("l_returnflag") == "R"), "unpaid")
        .when(open_amount & (F.col("l_returnflag") == "A"), "part_paid ")
        .otherwise("paid")
    )
    due = F.col("l_extendedprice")
    return (
        _read(spark, sf_dir, "lineitem")
        .join(orders, "l_orderkey")
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("invoice_id"),
            F.col("o_custkey").alias("customer_id"),
            F.add_months(F.trunc(F.lit(AS_OF), "month"), -months_back).alias("period_month"),
            due.alias("amount_due"),
            F.when(status == "unpaid", 0.0)
            .when(status == "part_paid ", F.floor(due / 2).cast("double"))
            .otherwise(due)
            .alias("amount_paid"),
            status.alias("status"),
        )
    )


def _event_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    days_back = 40 * F.datediff(F.lit(date(2024, 1, 30)), F.to_date("ts"))
    return _read(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        (F.col("user_id") * 10 + F.col("event_id") % 10).alias("cust"),
        (F.col("ts").cast("timestamp_ntz") - F.make_dt_interval(days_back)).alias("t"),
    )


def support_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    event_id = F.col("event_id")
    hours_open = F.make_dt_interval(F.lit(0), (event_id % 97).cast("int"))
    return _event_base(spark, sf_dir).select(
        event_id.alias("contact_id"),
        F.col("cust").alias("customer_id"),
        F.col("t").alias("created_at"),
        F.when(event_id % 3 == 0, "phone ").otherwise(" email").alias("channel"),
        F.when(kind == "click", "complaint ")
        .when(kind == "view", "technical_fault")
        .when(kind == "purchase", "billing")
        .otherwise("general")
        .alias("category"),
        F.when(event_id % 7 != 0, F.col("t") + hours_open).alias("resolved_at"),
    )


def portal_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return _event_base(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 3 != 0, F.concat(F.col("cust").cast("string"), F.lit(".0"))).alias("customer_id"),
        F.when(kind == "error", "support_ticket_open ").when(kind == "signup", "login").otherwise(kind).alias("event_type"),
        F.col("t").alias("event_timestamp"),
    )


def usage_daily(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """With ``parts`` lines meet their orders in so many tasks, which is to grow with the table; else Spark decides."""
    calls = F.col("l_quantity").cast("int") % 5
    # the usage day is a fixed number of days before the subscription's end, so lines roll up before the join
    rolled = (
        _read(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_orderkey").alias("subscription_id"),
            ((F.col("l_partkey") * 7 + F.col("l_linenumber")) % 75).cast("int").alias("days_back"),
        )
        .agg(
            F.sum(calls).alias("call_count"),
            F.sum(F.when(calls > 0, F.col("l_quantity") * 1.5).otherwise(0.0)).alias("call_minutes"),
            F.max(F.col("l_suppkey") % 12).alias("peak"),
        )
    )
    ends = distinct_subscriptions(spark, sf_dir).select(
        "subscription_id", F.coalesce("cancelled_date", F.lit(AS_OF)).alias("last_day")
    )
    if parts:
        rolled, ends = (side.repartition(parts, "subscription_id") for side in (rolled, ends))
    return rolled.join(ends, "subscription_id").select(
        "subscription_id",
        F.date_sub("last_day", F.col("days_back")).alias("usage_date"),
        F.col("call_count").cast("bigint").alias("call_count"),
        "call_minutes",
        F.when(F.col("call_count") == 0, 1).otherwise(F.greatest("peak", F.lit(1))).cast("bigint").alias("concurrent_peak"),
    )


def usage_lines(spark: SparkSession, sf_dir: str) -> int:
    """The number of line items, from the file footers: usage has no more rows."""
    return _read(spark, sf_dir, "lineitem").count()


RAW_TABLES = {
    "customers": customers,
    "subscriptions": subscriptions,
    "billings": billings,
    "support_contacts": support_contacts,
    "portal_events": portal_events,
    "usage_daily": usage_daily,
}


def _replaced(df: DataFrame, changes: dict[str, list[tuple[Column, Column]]]) -> DataFrame:
    """Columns replaced where a condition on the given row holds; the first that holds wins."""
    new = {}
    for column, cases in changes.items():
        value = F.when(*cases[0])
        for condition, other in cases[1:]:
            value = value.when(condition, other)
        new[column] = value.otherwise(F.col(column)).cast(df.schema[column].dataType)
    return df.withColumns(new)


def _twice(df: DataFrame, condition: Column) -> DataFrame:
    copies = F.when(condition, 2).otherwise(1)
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")


def defective(name: str, df: DataFrame) -> DataFrame:
    """A raw table as a careless source delivers it: every rule that the quality checks look for is broken somewhere."""
    c, null = F.col, F.lit(None)

    def every(key: str, n: int, rest: int) -> Column:
        return F.coalesce(c(key) % n == rest, F.lit(False))

    if name == "customers":
        return _twice(df, every("customer_id", 67, 1))
    if name == "subscriptions":
        key, status = "subscription_id", F.trim("status")
        changes = {
            "customer_id": [(every(key, 41, 7), -c("customer_id")), (every(key, 43, 8), null)],
            "status": [(every(key, 31, 5), F.lit(" paused"))],
            "cancelled_date": [(every(key, 29, 3) & (status == "active"), F.lit("2024-01-05").cast("date"))],
            "go_live_date": [
                (every(key, 37, 4) & (status == "active"), null),
                (every(key, 7, 6) & (status == "doa"), F.lit("2023-05-01").cast("date")),
            ],
            key: [(every(key, 499, 9), null)],
        }
        return _replaced(df, changes)
    if name == "billings":
        key, status = "invoice_id", F.trim("status")
        changes = {
            "amount_paid": [
                (every(key, 47, 1) & (status == "paid"), c("amount_due") + 1),
                (every(key, 53, 2) & (status == "unpaid"), F.lit(1.0)),
                (every(key, 13, 3) & (status == "part_paid"), F.lit(0.0)),
            ],
            "customer_id": [(every(key, 59, 4), null), (every(key, 61, 5), -c("customer_id"))],
            "period_month": [(every(key, 67, 6), null)],
        }
        return _twice(_replaced(df, changes), every(key, 71, 7))
    if name == "support_contacts":
        key = "contact_id"
        changes = {
            "customer_id": [(every(key, 103, 2), null), (every(key, 109, 4), -c("customer_id") - 1)],
            "created_at": [(every(key, 107, 3), null)],
            key: [(every(key, 101, 1), null)],
        }
        return _replaced(_twice(df, every(key, 89, 5)), changes)
    if name == "portal_events":
        key = "event_id"
        changes = {
            "customer_id": [(every(key, 107, 3), F.lit("-5.0"))],
            "event_timestamp": [(every(key, 103, 2), null)],
            key: [(every(key, 101, 1), null)],
        }
        return _replaced(_twice(df, every(key, 109, 4)), changes)
    key = "subscription_id"
    changes = {
        "usage_date": [(every(key, 89, 2), null)],
        "call_count": [(every(key, 97, 3), null), (every(key, 107, 6), F.lit(-1))],
        "call_minutes": [(every(key, 101, 4), null), (every(key, 109, 7), F.lit(-1.0))],
        "concurrent_peak": [(every(key, 103, 5), null), (every(key, 113, 8), F.lit(-1))],
        key: [(every(key, 83, 1), null), (every(key, 79, 9), -c(key) - 1)],
    }
    return _replaced(_twice(df, every(key, 73, 10)), changes)


def subscription_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two successive source states: keys arrive, vanish, change in tracked and in untracked columns.

    A key is missing in one of them at most. Some rows come twice, as in ``subscriptions``.
    """
    rows = subscriptions(spark, sf_dir)
    key = F.col("subscription_id")
    first = rows.where(key % 19 != 0)
    second = (
        rows.where(key % 19 != 7)
        .withColumn("mrr", F.when(key % 11 == 0, F.col("mrr") + 1).otherwise(F.col("mrr")))
        .withColumn("contract_term_months", F.when(key % 31 != 0, F.col("contract_term_months")))
        .withColumn("plan", F.when(key % 37 == 0, "plan_x").otherwise(F.col("plan")))
    )
    return first, second


def customer_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = customers(spark, sf_dir)
    key = F.col("customer_id")
    first = rows.where(key % 19 != 0)
    second = (
        rows.where(key % 19 != 7)
        .withColumn("region", F.when(key % 11 == 0, "MOVED").otherwise(F.col("region")))
        .withColumn("size_band", F.when(key % 31 != 0, F.col("size_band")))
        .withColumn("signup_date", F.when(key % 37 == 0, F.date_add("signup_date", 1)).otherwise(F.col("signup_date")))
    )
    return first, second
