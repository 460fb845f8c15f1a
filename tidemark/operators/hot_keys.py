"""Keeping work balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
LEAST_HOT_ROWS = 1_000  # below that a list of hot keys is too long to broadcast


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys (null included) with more than ``hot_rows`` rows, exactly, and ``_salts``: how many shares they are cut into.

    There are fewer than rows / hot_rows of them whatever the data, so the result may be broadcast:
    10^12 rows give at most 10^6 keys. Part of the lazy plan: one narrow shuffle of key counts, combined before it.
    """
    if hot_rows < LEAST_HOT_ROWS:
        raise ValueError(f"hot_rows must be at least {LEAST_HOT_ROWS}")
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > hot_rows)
        .select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.ceil(F.col("_rows") / max(hot_rows, 1)).cast("int").alias("_salts"))
    )


def _with_salts(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    is_hot = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    return df.join(F.broadcast(hot), is_hot, "left")


def salted(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with ``_salt``: 0, or for rows of a hot key one of its shares.

    The share is drawn from the row and the task that holds it, so equal rows are spread too, and a task that runs again
    draws the same.
    """
    share = F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.col("_salts")).cast("int")
    return _with_salts(df, hot, keys).select(*df.columns, F.coalesce(share, F.lit(0)).alias("_salt"))


def copied(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with ``_salt``: each row once, those of a hot key once for each of its shares."""
    shares = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return _with_salts(df, hot, keys).select(*df.columns, F.explode(shares).alias("_salt"))


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], how: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Equi join to a right side with one row per key; ``how`` is inner, left, left_semi or left_anti.

    One salted join: the rows of a hot left key are cut into shares, and the one right row of that key is copied to each.
    The copies number fewer than left rows / hot_rows * 2. Besides the join, only the keys of the left side are read, to count.
    """
    hot = hot_keys(left, keys, hot_rows)
    met = salted(left, hot, keys).join(copied(right, hot, keys), [*keys, "_salt"], how)
    return met.drop("_salt")
