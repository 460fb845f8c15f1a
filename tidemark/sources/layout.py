"""Storage that spares later reads work: buckets for joins, a sorted index for look-ups, footers for counts and bounds."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructType

# Column types whose bounds Spark takes from Parquet footers (fixed values)
BOUNDED = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DateType)


BUCKET_ROWS = 500_000  # a task writes, sorts and joins one bucket


def buckets_for(rows: int, least: int = 8) -> int:
    """How many buckets hold a table of ``rows`` rows, so that no task's share grows with the table."""
    return max(least, -(-rows // BUCKET_ROWS))


def publish_buckets(df: DataFrame, name: str, path: str, key: str, buckets: int, sort_by: tuple[str, ...] = ()) -> DataFrame:
    """Store a table in ``buckets`` files by the hash of ``key``, sorted by key and ``sort_by``, and read it by its name.

    Two tables with equally many buckets on one key join and group on it without a shuffle. A key must not be hot: roll the rows
    up first (``daily_usage``). Rows are dealt out once, one task a bucket, so each bucket is one sorted file.
    """
    rows = df.repartition(buckets, key)
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key, *sort_by).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def attach_buckets(
    spark: SparkSession, name: str, path: str, schema: StructType, key: str, buckets: int, sort_by: tuple[str, ...] = ()
) -> DataFrame:
    """A table stored by ``publish_buckets`` under a name of another session's catalogue."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    order = ", ".join(f"`{c}`" for c in (key, *sort_by))
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY ({order}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def publish_index(df: DataFrame, path: str, key: str, within: tuple[str, ...], keys_per_file: int = 100_000) -> DataFrame:
    """Store a table for look-ups by ``key``: in ranges of (key, within), sorted, with a Bloom filter of the keys per row group.

    A look-up opens the footers, and reads only pages whose bounds hold the key and row groups whose filter has it. A hot key
    is spread over several files by the columns ``within``.
    """
    order = [key, *within]
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = rows.write.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.option(f"parquet.bloom.filter.expected.ndv#{key}", str(keys_per_file)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session of its own on the same context, in which counts and bounds are pushed down to the footers."""
    session = spark.newSession()
    others = [s for s in session.conf.get("spark.sql.sources.useV1SourceList").split(",") if s != "parquet"]
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(others))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def column_bounds(rows: DataFrame) -> DataFrame:
    """One row: n_rows, and low_ and high_ of each column of numbers or days."""
    columns = [f.name for f in rows.schema if isinstance(f.dataType, BOUNDED)]
    bounds = [f(c).alias(f"{side}_{c}") for c in columns for side, f in (("low", F.min), ("high", F.max))]
    return rows.agg(F.count("*").alias("n_rows"), *bounds)


def footer_bounds(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """(table_name, column_name, n_rows, low, high, low_day, high_day) of each column of numbers or days of stored tables.

    ``tables`` gives the path of each name. Taken from the statistics in the Parquet footers: no row is read. Where a file has
    none for a column, as for one that holds nulls only, the table is scanned instead. Numbers have bounds as double, days as
    date; nulls are passed over. Runs one job a table, which returns one row.
    """
    out = []
    for name, path in tables.items():
        stored = spark.read.parquet(path)
        try:
            found = column_bounds(_footer_session(spark).read.parquet(path)).first()
        except (PySparkException, Py4JJavaError) as error:
            if "No min/max found" not in str(error):
                raise
            found = column_bounds(stored).first()
        for field in stored.schema:
            if isinstance(field.dataType, BOUNDED):
                bounds = found[f"low_{field.name}"], found[f"high_{field.name}"]
                none = (None, None)
                if isinstance(field.dataType, DateType):
                    row = (*none, *bounds)
                else:
                    row = (*[None if b is None else float(b) for b in bounds], *none)
                out.append((name, field.name, found.n_rows, *row))
    return spark.createDataFrame(
        out, "table_name string, column_name string, n_rows long, low double, high double, low_day date, high_day date"
    )
