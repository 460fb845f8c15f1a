"""Casts and trims that turn a raw column into its staged type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Raw:
    """Columns of one raw table in their staged types.

    A column that has its type already is passed as it is: an alias without effect would make equal subplans differ,
    and Spark would no longer see that it can share their shuffles.
    """

    def __init__(self, df: DataFrame):
        self.types = dict(df.dtypes)

    def _as(self, name: str, target: str) -> Column:
        return F.col(name) if self.types[name] == target else F.col(name).cast(target).alias(name)

    def whole(self, name: str) -> Column:
        return self._as(name, "bigint")

    def whole_from_decimal(self, name: str) -> Column:
        """An id that arrives as decimal text ('57.0'): rounded, as a plain cast to integer would cut or raise."""
        return F.round(F.col(name).cast("decimal(38,2)"), 0).cast("bigint").alias(name)

    def text(self, name: str) -> Column:
        return F.trim(F.col(name)).alias(name)

    def money(self, name: str) -> Column:
        return self._as(name, "decimal(10,2)")

    def calendar_day(self, name: str) -> Column:
        return self._as(name, "date")

    def moment(self, name: str) -> Column:
        return self._as(name, "timestamp_ntz")
