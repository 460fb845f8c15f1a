"""Slowly changing dimension, type 2: keep every version of a row with its validity."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION_COLUMNS = ["scd_id", "updated_at", "valid_from", "valid_to"]


def _stamp(loaded_at: datetime) -> str:
    return f"{loaded_at:%Y-%m-%d %H:%M:%S}" + (f".{loaded_at.microsecond:06d}" if loaded_at.microsecond else "")


MOST_COPIES = 1_000_000  # of one row unfolded in one step


def _conflict(key: Column) -> Column:
    return F.raise_error(F.concat(F.lit("snapshot: different rows share the key "), key.cast("string")))


def _differs(checked: list[str], one: Column, other: Column) -> Column:
    return reduce(or_, [~one[c].eqNullSafe(other[c]) for c in checked], F.lit(False))


def _merged(
    current: DataFrame, stored: DataFrame | None, key: str, check_cols: list[str], loaded_at: datetime
) -> DataFrame:
    """All versions after the load, in one pass: both sides are read once, laid into one table and grouped by key once.

    Equal rows fold into one row with a count ahead of the shuffle, so copies do not gather. Rows that meet nothing, those
    without a key and closed versions, are grouped by their whole content instead.
    """
    columns = current.columns
    stamp = _stamp(loaded_at)
    at = F.lit(stamp).cast("timestamp_ntz")
    never = F.lit(None).cast("timestamp_ntz")
    fresh = current.select(
        *columns,
        F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(stamp))).alias("scd_id"),
        at.alias("updated_at"),
        at.alias("valid_from"),
        never.alias("valid_to"),
        F.lit(True).alias("_is_new"),
    )
    both = fresh
    if stored is not None:
        both = stored.select(*columns, *VERSION_COLUMNS, F.lit(False).alias("_is_new")).unionByName(fresh)
    row = F.struct(*columns, *VERSION_COLUMNS)
    is_new, is_closed = F.col("_is_new"), F.col("valid_to").isNotNull()
    alone = F.when(is_closed | F.col(key).isNull(), F.struct("_is_new", row.alias("row")))
    sides = {"now": row if stored is None else F.when(is_new, row)}
    sides["was"] = F.lit(None).cast(both.select(row.alias("row")).schema["row"].dataType) if stored is None else F.when(~is_new, row)
    folded = [f(c).alias(name + side) for side, c in sides.items() for name, f in (("", F.min), ("other_", F.max), ("n_", F.count))]
    grouped = both.groupBy(F.col(key).alias("_key"), alone.alias("_alone")).agg(*folded)
    # different rows under one key make the comparison ambiguous
    ambiguous = ~F.col("was").eqNullSafe(F.col("other_was")) | ~F.col("now").eqNullSafe(F.col("other_now"))
    checked = [c for c in check_cols if c != key]
    was, now = F.col("was"), F.col("now")
    meets_nothing = F.col("_alone").isNotNull()
    keeps = ~meets_nothing & was.isNotNull() & now.isNotNull() & ~_differs(checked, was, now)
    closes = was["valid_to"].isNull() & ~keeps
    reviewed = was.withField("valid_to", F.when(closes, at).otherwise(was["valid_to"]))
    # the first load is a faithful copy, and rows without a key match no other; else copies count as one row
    copies = F.col("n_now") if stored is None else F.when(meets_nothing, F.col("n_now")).otherwise(F.least("n_now", F.lit(1)))
    versions = F.array(
        F.struct(F.col("n_was").alias("n"), reviewed.alias("row")),
        F.struct(F.when(keeps, 0).otherwise(copies).alias("n"), now.alias("row")),
    )
    checked_versions = F.when(ambiguous, _conflict(F.col("_key"))).otherwise(F.lit(True))
    each = (
        grouped.where(checked_versions)
        .select(F.inline(versions))
        .where("n > 0")
        .select("row", F.col("n").cast("long").alias("n"))
    )
    # copies unfold in steps, so no array grows with their number
    last_step = F.floor((F.col("n") - 1) / MOST_COPIES).cast("long")
    steps = each.select("row", "n", F.explode(F.sequence(F.lit(0).cast("long"), last_step)).alias("_step"))
    left = F.least(F.col("n") - F.col("_step") * MOST_COPIES, F.lit(MOST_COPIES))
    return steps.select("row", F.explode(F.array_repeat(F.lit(True), left.cast("int"))).alias("_copy")).select("row.*")


def load(
    current: DataFrame, open_rows: DataFrame | None, key: str, check_cols: list[str], loaded_at: datetime
) -> DataFrame:
    """The versions still open after loading ``current``, and those the load closed. Closed history is not needed.

    The first load (``open_rows`` None) is a faithful copy, duplicates included, unless two different rows share a key:
    that fails it, as it would fail any later load. Later loads close the open versions
    whose key is gone or whose checked columns differ (nulls compare as values), and open a version for each current
    row without a valid one. A change in other columns opens nothing. Copies count as one row; different rows under one
    key make the comparison ambiguous and fail the load.
    """
    return _merged(current, open_rows, key, check_cols, loaded_at)


def snapshot(
    current: DataFrame, history: DataFrame | None, key: str, check_cols: list[str], loaded_at: datetime
) -> DataFrame:
    """The whole history after loading ``current``; closed versions pass through untouched.

    Each load adds one shuffle to the plan. A long history is better stored, and loaded by its open versions (``load``).
    """
    return _merged(current, history, key, check_cols, loaded_at)
