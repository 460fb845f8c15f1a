"""When was something last seen before a reference day?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.hot_keys import HOT_ROWS, copied, hot_keys, salted


def _sightings_by_day(sightings: DataFrame, key: str, marks: list[str]) -> DataFrame:
    return sightings.where(F.col(key).isNotNull() & F.col("seen_on").isNotNull()).select(
        F.col(key).alias("_key"), F.col("seen_on").alias("_day"), *marks
    )


def last_seen_before(
    anchors: DataFrame, sightings: DataFrame, key: str, day: str, totals: list[str], marks: list[str]
) -> DataFrame:
    """One row per (key, day) of ``anchors``: its ``totals`` summed, and per mark the latest sighting before that day.

    ``sightings`` has the key, the day ``seen_on`` and one boolean column per mark. An event lies in the window
    [day - n, day) exactly if the latest event before ``day`` is not older than day - n, so no event is ever paired
    with an anchor. Both inputs are first rolled up to one row per key and day; the window over a key then holds at
    most one row per calendar day, however many rows the key has.
    """
    wanted = anchors.select(F.col(key).alias("_key"), F.col(day).alias("_day"), F.lit(True).alias("_anchor"), *totals)
    rolled = (
        wanted.unionByName(_sightings_by_day(sightings, key, marks), allowMissingColumns=True)
        .groupBy("_key", "_day")
        .agg(
            F.max("_anchor").alias("_anchor"),
            *[F.sum(t).alias(t) for t in totals],
            *[F.max(F.when(F.col(m), F.col("_day"))).alias(m) for m in marks],
        )
    )
    earlier = Window.partitionBy("_key").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rolled.select("*", *[F.max(m).over(earlier).alias(f"last_{m}") for m in marks])
        .where("_anchor")
        .select(F.col("_key").alias(key), F.col("_day").alias(day), *totals, *[f"last_{m}" for m in marks])
    )


def rows_with_last_seen(
    anchors: DataFrame, sightings: DataFrame, key: str, day: str, marks: list[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every row of ``anchors`` with, per mark, the latest sighting of its key before its day: an as-of join.

    Rows and sightings are laid into one order per key and a running maximum passes over both, so there is no join back to
    the rows. Sightings are rolled up to one row per key and day. A key with more than ``hot_rows`` anchors is cut into
    shares, and its sightings, at most one per calendar day, are copied to each. Rows without a key or a day keep their place
    and have seen nothing.
    """
    seen = _sightings_by_day(sightings, key, marks).groupBy("_key", "_day")
    seen = seen.agg(*[F.max(F.when(F.col(m), F.col("_day"))).alias(m) for m in marks])
    rows = anchors.select(F.struct(*anchors.columns).alias("_row"), F.col(key).alias("_key"), F.col(day).alias("_day"))
    hot = hot_keys(anchors.select(F.col(key).alias("_key")), ["_key"], hot_rows)
    both = salted(rows, hot, ["_key"]).unionByName(copied(seen, hot, ["_key"]), allowMissingColumns=True)
    # on one day rows come ahead of sightings: the day itself does not count
    order = [F.col("_day"), F.col("_row").isNull()]
    earlier = Window.partitionBy("_key", "_salt").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        both.select("_row", *[F.max(m).over(earlier).alias(f"last_{m}") for m in marks])
        .where("_row IS NOT NULL")
        .select("_row.*", *[f"last_{m}" for m in marks])
    )


def within(mark: str, day: str, days: int) -> Column:
    """Whether the latest sighting of ``mark`` lies in the ``days`` days before ``day``; false if there is none."""
    return F.coalesce(F.col(f"last_{mark}") >= F.date_sub(day, days), F.lit(False))
