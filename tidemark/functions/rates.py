"""Rates over counts; every one is null where its denominator is zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _nonzero(n: Column) -> Column:
    return F.when(n != 0, n)


def percent(part: Column, total: Column, digits: int) -> Column:
    """part / total in percent. Decimal arithmetic, multiplied first, so that halves round up exactly."""
    hundredfold = part.cast("decimal(18,0)") * 100
    return F.round(hundredfold / _nonzero(total), digits).cast("double")


def compounded_percent(part: Column, total: Column, periods: int) -> Column:
    """Loss over several periods at a per-period rate of part / total: 1 - (1 - r)^periods."""
    kept = 1 - part.cast("double") / _nonzero(total)
    return F.round((1 - F.pow(kept, F.lit(float(periods)))) * 100, 2)


def risk_ratio(part_a: Column, total_a: Column, part_b: Column, total_b: Column) -> Column:
    """(part_a / total_a) / (part_b / total_b), two digits."""
    rate_a = part_a.cast("double") / _nonzero(total_a)
    rate_b = part_b.cast("double") / _nonzero(total_b)
    return F.round(rate_a / _nonzero(rate_b), 2)
