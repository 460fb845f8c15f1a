"""Loads and publications proved by reading them back: every function writes to a folder of its own and returns what is there."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.snapshot import load
from tidemark.plans import facts, indicators, staging
from tidemark.sources import layout, tables


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def through_csv(rows: DataFrame, table: str, folder: str, broken: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """A raw table written as CSV and loaded again: the rows that fit, and the stored rejects.

    ``broken`` replaces columns by other texts, where it is not null, before writing.
    """
    texts = {f.name: F.col(f.name).cast("string") for f in rows.schema}
    for column, text in (broken or {}).items():
        texts[column] = F.coalesce(text, texts[column])
    lines = rows.select(*[text.alias(name) for name, text in texts.items()])
    # quoted in full, as the padded texts would lose their blanks otherwise
    lines.write.csv(f"{folder}/csv", header=True, quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    spark = rows.sparkSession
    good = tables.load_csv(spark, f"{folder}/csv", table, f"{folder}/rejects")
    return good, tables.current_table(spark, f"{folder}/rejects")


def load_report(good: DataFrame, rejected: DataFrame, key: str) -> DataFrame:
    """(key, is_rejected, reason) of every line of a load; the key of a rejected line is its first field."""
    first = F.regexp_extract("record", '^"?([^",]*)', 1).cast("long").alias(key)
    return good.select(key, F.lit(False).alias("is_rejected"), F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select(first, F.lit(True).alias("is_rejected"), "reason")
    )


def through_parquet(rows: DataFrame, table: str, folder: str) -> DataFrame:
    rows.write.parquet(folder)
    return tables.read_parquet(rows.sparkSession, folder, table)


def through_catalogue(rows: DataFrame, folder: str) -> DataFrame:
    """A raw table behind a view in the catalogue, read by its name."""
    spark, name = rows.sparkSession, _name("stored")
    rows.write.parquet(folder)
    tables.publish_catalogue_view(spark, name, folder)
    return tables.source(spark, spark.catalog.currentDatabase(), name)


def through_view(rows: DataFrame) -> DataFrame:
    name = _name("view")
    tables.publish_view(rows, name)
    return rows.sparkSession.table(name)


def monthly_through_table(lifecycle: DataFrame, as_of: date, folder: str) -> DataFrame:
    """The monthly fact as the newest version of a partitioned table."""
    publish_monthly(lifecycle, as_of, folder)
    return tables.current_table(lifecycle.sparkSession, folder)


def publish_monthly(lifecycle: DataFrame, as_of: date, path: str) -> DataFrame:
    """Store the monthly fact by month. Its rows are unfolded behind the shuffle, which moves one for each block of months."""
    blocks = facts.monthly_blocks(lifecycle, as_of)
    return tables.publish_table(blocks, path, "activity_month", ("subscription_id",), "_block", facts.unfolded)


def stored_history(spark: SparkSession, name: str, loads: list[tuple[DataFrame, datetime]], folder: str) -> DataFrame:
    """The whole history after a chain of stored loads, each of which reads the open versions that the one before it left."""
    key, check_cols = staging.TRACKED[name]
    schema = tables.history_schema(loads[0][0].schema)
    for rows, at in loads:
        before = tables.open_versions(spark, folder, schema)
        tables.publish_history(load(rows, before, key, check_cols, at), folder, at)
    return tables.read_history(spark, folder, schema)


def usage_flags_from_buckets(base: DataFrame, usage: DataFrame, folder: str, buckets: int) -> DataFrame:
    """The usage signals of base and usage as they are stored for it: both in buckets of the subscription."""
    key = "subscription_id"
    days = layout.publish_buckets(indicators.daily_usage(usage), _name("days"), f"{folder}/days", key, buckets, ("usage_date",))
    anchors = layout.publish_buckets(base, _name("base"), f"{folder}/base", key, buckets)
    return indicators.usage_flags(anchors, days)


def entity_from_index(lifecycle: DataFrame, folder: str, customer_id: int, product_type: str) -> DataFrame:
    """All rows of one customer and product, looked up in the lifecycle as it is stored for that."""
    index = layout.publish_index(lifecycle, folder, "customer_id", ("product_type", "subscription_id"))
    return index.where((F.col("customer_id") == customer_id) & (F.col("product_type") == product_type))
