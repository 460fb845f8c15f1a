"""Calendar expressions. All stay DATE / whole numbers, so none depends on the session time zone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(as_of: date) -> Column:
    return F.lit(as_of).cast("date")


def month_start(col: Column) -> Column:
    return F.trunc(col, "month")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def hours_crossed(start: Column, end: Column) -> Column:
    """Hour boundaries between two timestamps: 0:59 to 1:01 is one hour, null if either is null."""
    whole_days = F.datediff(F.to_date(end), F.to_date(start)) * 24
    return (whole_days + F.hour(end) - F.hour(start)).cast("bigint")


def months_apart(first: Column, last: Column) -> Column:
    """Calendar months from the month of ``first`` to the month of ``last``."""
    return (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)
