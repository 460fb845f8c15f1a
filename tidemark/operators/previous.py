"""The previous row of a group, also for groups too large for one task."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


INDEX = (1 << 33) - 1  # the bits of monotonically_increasing_id that count the rows of a partition


def with_previous(df: DataFrame, group: list[str], day: str, row_id: str, values: list[str]) -> DataFrame:
    """Add ``prev_<value>``: the value one row earlier within ``group``, ordered by day (nulls last), then row id.

    ``row_id`` makes the order total. The rows are dealt out in ranges of (group, day, id), so a large group is spread over
    as many parts as any other rows, and a part is a stretch of the whole order: the row before is the one ahead in the same
    part, but for the first row of each part. So each part's last row, the first when it is sorted backwards, is sent to
    the next part as well. Parts but the last are never empty, as each ends with a row of the table; a first row without one
    ahead fails the job. ``df`` is read once, and nothing is counted or broadcast.
    """
    keys = [*[F.col(c).asc_nulls_first() for c in group], F.col(day).asc_nulls_last(), F.col(row_id).asc_nulls_last()]
    back = [*[F.col(c).desc_nulls_last() for c in group], F.col(day).desc_nulls_first(), F.col(row_id).desc_nulls_first()]
    ranges = df.repartitionByRange(*keys).sortWithinPartitions(*back)
    numbered = ranges.select("*", F.spark_partition_id().alias("_own"), F.monotonically_increasing_id().alias("_place"))
    is_last = F.col("_place").bitwiseAND(F.lit(INDEX)) == 0
    parts = F.when(is_last, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(F.array("_own"))
    sent = numbered.select(*df.columns, "_own", F.explode(parts).alias("_part"))

    inside = Window.partitionBy("_part").orderBy(*keys)
    ahead = {**{f"_group_{c}": F.col(c) for c in group}, **{f"_value_{v}": F.col(v) for v in values}, "_is_ahead": F.lit(True)}
    rows = sent.select(*df.columns, "_own", "_part", *[F.lag(c).over(inside).alias(name) for name, c in ahead.items()])
    # no equality, from which Catalyst would derive conditions that look at copies as if they were none
    at_home = F.col("_part") - F.col("_own") < 1
    rows = rows.where(at_home)
    broken = F.col("_is_ahead").isNull() & (F.col("_part") > 0) & at_home
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_group_{c}")) for c in group], F.col("_is_ahead").isNotNull())
    return rows.select(
        *df.columns,
        *[
            F.when(broken, F.raise_error(F.lit("with_previous: an empty part"))).when(same, F.col(f"_value_{v}")).alias(f"prev_{v}")
            for v in values
        ],
    )
