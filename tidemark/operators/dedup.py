"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_row_per_key(df: DataFrame, keys: list[str], prefer: list[Column]) -> DataFrame:
    """Keep the first row of each key in ``prefer`` order; make that order total for a repeatable choice.

    Catalyst turns the rank filter into a group limit before the shuffle, so a key's copies shrink to one row
    per input task before they move.
    """
    ranked = Window.partitionBy(*keys).orderBy(*prefer)
    return df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") == 1).drop("_rank")
