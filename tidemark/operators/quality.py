"""Data-quality measures. Each makes one pass over its table and returns few rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """(check_name, table_name, n_rows, n_violations): rows for which each condition holds, all in one scan."""
    totals = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count(F.when(condition, True)).alias(f"c{i}") for i, condition in enumerate(checks.values())],
    )
    rows = [F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("n")) for i, name in enumerate(checks)]
    return totals.select("n_rows", F.inline(F.array(*rows))).select(
        "check_name", F.lit(table).alias("table_name"), "n_rows", F.col("n").alias("n_violations")
    )


def null_checks(columns: list[str]) -> dict[str, Column]:
    return {f"{c}_is_null": F.col(c).isNull() for c in columns}


def duplicate_rows(df: DataFrame, table: str) -> DataFrame:
    """(table_name, n_rows, n_distinct, n_repeated): full-row copies; n_repeated counts rows that occur more than once.

    Only a 64-bit hash of each row is shuffled first. Rows whose hash occurs once are their own; the whole rows of the
    other hashes, copies and the rare different rows of one hash, are then compared as they are.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    hashes = hashed.groupBy("_hash").agg(F.count("*").alias("n"))
    single = hashes.where("n = 1").agg(F.count("*").alias("single"))
    again = hashes.where("n > 1").select("_hash")
    copies = hashed.join(again, "_hash", "left_semi").groupBy(*df.columns).agg(F.count("*").alias("n"))
    totals = copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct"),
        F.count(F.when(F.col("n") > 1, True)).alias("n_repeated"),
    )
    parts = single.select("single", F.lit(0).alias("rows"), F.lit(0).alias("distinct"), F.lit(0).alias("n_repeated"))
    parts = parts.unionByName(totals.select(F.lit(0).alias("single"), "*"))
    return parts.agg(
        F.sum(F.col("single") + F.col("rows")).alias("n_rows"),
        F.sum(F.col("single") + F.col("distinct")).alias("n_distinct"),
        F.sum("n_repeated").alias("n_repeated"),
    ).select(F.lit(table).alias("table_name"), "n_rows", "n_distinct", "n_repeated")


def counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """How often each value occurs, most frequent first. Ties are ordered too, so that the sort can split them."""
    return df.groupBy(*columns).agg(F.count("*").alias("cnt")).orderBy(F.col("cnt").desc(), *columns)


def repeated(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values that occur more than once, with their count: the key check, or the copies if all columns are given."""
    return df.groupBy(*columns).agg(F.count("*").alias("cnt")).where(F.col("cnt") > 1)


def key_uniqueness(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """(table_name, key_columns, n_keys, n_keys_repeated)."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.agg(
        F.count("*").alias("n_keys"), F.count(F.when(F.col("n") > 1, True)).alias("n_keys_repeated")
    ).select(F.lit(table).alias("table_name"), F.lit(", ".join(keys)).alias("key_columns"), "n_keys", "n_keys_repeated")


def frequencies(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """(table_name, column_name, value, cnt): how often each value of several columns occurs, counted in one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return (
        df.select(F.inline(pairs))
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("cnt"))
        .select(F.lit(table).alias("table_name"), "column_name", "value", "cnt")
    )


def ranges(
    df: DataFrame, table: str, days: list[str] = (), moments: list[str] = (), amounts: list[str] = ()
) -> DataFrame:
    """One row per column with its smallest and largest value, in the pair of columns of its type."""
    kinds = {**{c: "date" for c in days}, **{c: "timestamp" for c in moments}, **{c: "amount" for c in amounts}}
    types = {"date": "date", "timestamp": "timestamp_ntz", "amount": "decimal(10,2)"}
    bounds = df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in kinds for f in (F.min, F.max)])

    def bound(column: str, side: str, kind: str) -> Column:
        value = F.col(f"{side}_{column}") if kinds[column] == kind else F.lit(None)
        return value.cast(types[kind]).alias(f"{side}_{kind}")

    rows = [
        F.struct(F.lit(c).alias("column_name"), *[bound(c, side, kind) for kind in types for side in ("min", "max")])
        for c in kinds
    ]
    return bounds.select(F.lit(table).alias("table_name"), F.inline(F.array(*rows)))


def _word(key: str) -> Column:
    """The number of the group of 64 neighbouring whole numbers that a key belongs to."""
    return F.shiftright(F.col(key).cast("long"), 6)


def known_ids(parent: DataFrame, key: str) -> DataFrame:
    """(word, ids): the whole-number keys of a table as a set of bits, 64 neighbouring keys in one row.

    Built in each task and combined, so a table of keys without gaps shuffles one row in 64 of it; at worst, with keys far
    apart, one short row per key. Negative keys are keys like others, null is none.
    """
    bit = F.expr(f"shiftleft(1L, cast(cast(`{key}` AS bigint) & 63 AS int))")
    return parent.where(F.col(key).isNotNull()).groupBy(_word(key).alias("word")).agg(F.bit_or(bit).alias("ids"))


def orphans(children: dict[str, DataFrame], parent: DataFrame, parent_name: str, key: str) -> DataFrame:
    """(child_table, parent_table, key_column, n_rows, n_orphans) of each child: rows whose whole-number key the parent lacks.

    Null keys are not orphans and not counted. Children are counted per key before the one join of all of them with the
    parent's set of bits, so a key with many rows moves as one row per task.
    """
    tables = [df.where(F.col(key).isNotNull()).select(F.lit(t).alias("child_table"), key) for t, df in children.items()]
    counted = reduce(DataFrame.unionByName, tables).groupBy(key, "child_table").agg(F.count("*").alias("n"))
    counted = counted.select("child_table", "n", _word(key).alias("word"), F.col(key).cast("long").bitwiseAND(F.lit(63)).alias("bit"))
    is_known = F.coalesce(F.getbit("ids", F.col("bit").cast("int")) == 1, F.lit(False))
    found = counted.join(known_ids(parent, key), "word", "left")
    found = found.select("child_table", "n", F.when(~is_known, F.col("n")).alias("lost"))
    # a row for each table, also one without rows
    names = parent.sparkSession.createDataFrame([(t, 0, None) for t in children], "child_table string, n long, lost long")
    sums = found.unionByName(names).groupBy("child_table")
    return sums.agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum("lost"), F.lit(0)).alias("n_orphans")).select(
        "child_table", F.lit(parent_name).alias("parent_table"), F.lit(key).alias("key_column"), "n_rows", "n_orphans"
    )
