"""Where raw tables come from and where results go."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType, TimestampNTZType

from tidemark.sources.schemas import RAW


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A raw table from CSV files with a header; a row that does not fit the declared schema fails the job."""
    return spark.read.schema(RAW[table]).csv(path, header=True, mode="FAILFAST", enforceSchema=False)


def read_csv_or_reject(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, DataFrame]:
    """The rows of CSV files that fit the declared schema, and the others as (file, record, reason).

    Every line is one or the other, whichever columns are asked for. The reason names the first column whose text is not of its
    type; without one the line has too few or too many fields. Both frames are lazy and read the files.
    """
    fields = StructType.fromDDL(RAW[table]).fields
    columns = [f.name for f in fields]
    marked = StructType([*fields, StructField("_rejected", StringType())])
    rows = spark.read.schema(marked).csv(
        path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_rejected", enforceSchema=False
    )
    # the reader checks the fields it is asked for, so each row asks for all of them, in a condition that always holds
    rows = rows.where(F.xxhash64(*columns) >= F.lit(-(1 << 63)))
    fits = F.col("_rejected").isNull()
    texts = F.from_csv("_rejected", ", ".join(f"{c} string" for c in columns))
    reason = F.lit("number of fields")
    for field in reversed(fields):
        text = F.col(f"_texts.{field.name}")
        wrong = text.isNotNull() & (text != "") & text.try_cast(field.dataType).isNull()
        reason = F.when(wrong, F.lit(f"{field.name} is no {field.dataType.simpleString()}")).otherwise(reason)
    rejected = rows.where(~fits).select(F.input_file_name().alias("file"), F.col("_rejected").alias("record"), texts.alias("_texts"))
    return rows.where(fits).select(columns), rejected.select("file", "record", reason.alias("reason"))


def load_csv(spark: SparkSession, path: str, table: str, rejects: str) -> DataFrame:
    """The rows of CSV files that fit the declared schema; the others are first stored as a version of the table ``rejects``."""
    good, rejected = read_csv_or_reject(spark, path, table)
    publish_table(rejected, rejects)
    return good


def read_parquet(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.schema(RAW[table]).parquet(path)


def source(spark: SparkSession, namespace: str, table: str) -> DataFrame:
    """A raw table by its catalogue name."""
    return spark.table(f"`{namespace}`.`{table}`")


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def publish_catalogue_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A view in the catalogue over a stored Parquet table; it outlives the session that makes it."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    return spark.table(name)


def _mark(spark: SparkSession, root: str, version: str, compacted: bool = False) -> None:
    """Note a finished version: the last step of each write, so readers never see half of one."""
    kinds = "version string, compacted boolean"
    spark.createDataFrame([(version, compacted)], kinds).coalesce(1).write.mode("append").parquet(f"{root}/finished")


def _finished(spark: SparkSession, root: str) -> list[tuple[str, bool]]:
    """Finished versions, oldest first, and whether each holds all earlier ones too."""
    try:
        rows = spark.read.schema("version string, compacted boolean").parquet(f"{root}/finished").distinct().collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((r.version, r.compacted) for r in rows)


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
DEALT_BYTES = 16 << 20  # of rows that are yet to be unfolded, in one task


@contextmanager
def _advisory_size(spark: SparkSession, size: int) -> Iterator[None]:
    """What AQE makes of the plans of this session meanwhile: tasks that read some ``size`` bytes."""
    given = spark.conf.get(ADVISORY)
    spark.conf.set(ADVISORY, str(size))
    try:
        yield
    finally:
        spark.conf.set(ADVISORY, given)


def publish_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    sort_by: tuple[str, ...] = (),
    deal_by: str | None = None,
    unfold: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Write a table in full, in a folder of its own below ``path``, and read it back.

    Earlier versions stay, so frames that read them go on working; ``current_table`` reads the newest.
    With a partition column the rows are rebalanced on it first: AQE merges small partitions and splits large
    ones to its advisory size, so a month neither breaks into one file per task nor ends in one task.
    With ``unfold`` a row of ``df`` stands for several of the table, in a few partitions: rows are rebalanced on the column
    ``deal_by``, which says which ones, and unfolded after the shuffle. The advisory size is then DEALT_BYTES, for this write.
    """
    if partition_by:
        df = df.hint("rebalance", F.col(deal_by or partition_by))
        df = unfold(df) if unfold else df
        df = df.sortWithinPartitions(partition_by, *sort_by)
    elif sort_by:
        df = df.sortWithinPartitions(*sort_by)
    spark, version = df.sparkSession, f"{datetime.now():%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with _advisory_size(spark, DEALT_BYTES) if unfold else nullcontext():
        writer.parquet(f"{path}/{version}")
    _mark(spark, path, version)
    return spark.read.schema(df.schema).parquet(f"{path}/{version}")


def current_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest finished version of a published table; None before the first."""
    finished = _finished(spark, path)
    return spark.read.parquet(f"{path}/{finished[-1][0]}") if finished else None


def _version(loaded_at: datetime) -> str:
    return f"{loaded_at:%Y%m%dT%H%M%S%f}"


def history_schema(raw: StructType) -> StructType:
    """The columns of a history over rows of the given ones."""
    version = [StructField("scd_id", StringType())]
    version += [StructField(c, TimestampNTZType()) for c in ("updated_at", "valid_from", "valid_to")]
    return StructType([*raw.fields, *version])


def is_stored(spark: SparkSession, root: str, loaded_at: datetime) -> bool:
    """Whether this load is finished already. One after it means that this load came too late."""
    finished = [version for version, _ in _finished(spark, root)]
    if finished and finished[-1] > _version(loaded_at):
        raise ValueError(f"{root}: a load later than {loaded_at} is already stored")
    return _version(loaded_at) in finished


def publish_history(changes: DataFrame, root: str, loaded_at: datetime) -> None:
    """Store one load of a history table: its open versions and the versions it closed, in a folder of its own.

    Nothing that a reader or the load itself reads is overwritten, and earlier closed versions are not written
    again, so a load costs what is open, not what is stored. A load that is stored already is left as it is.
    """
    spark = changes.sparkSession
    if is_stored(spark, root, loaded_at):
        return
    rows = changes.withColumn("is_open", F.col("valid_to").isNull())
    # a folder that is not noted as finished is left from a failed run and may be replaced
    rows.write.mode("overwrite").partitionBy("is_open").parquet(f"{root}/version={_version(loaded_at)}")
    _mark(spark, root, _version(loaded_at))


def _stored(spark: SparkSession, root: str, schema: StructType, finished: list[tuple[str, bool]]) -> DataFrame:
    """All rows of some versions with ``version`` and ``is_open``, in one listing; the schema is declared, so that
    versions without any row can be read too."""
    folders = [f"{root}/version={version}{'-compacted' if compacted else ''}" for version, compacted in finished]
    partitions = [StructField("version", StringType()), StructField("is_open", BooleanType())]
    rows = spark.read.schema(StructType([*schema.fields, *partitions])).option("basePath", root)
    return rows.option("ignoreMissingFiles", "false").parquet(*folders)


def _since_compaction(finished: list[tuple[str, bool]]) -> list[tuple[str, bool]]:
    """The newest compacted version and those after it."""
    compacted = [version for version, whole in finished if whole]
    if not compacted:
        return finished
    return [f for f in finished if f[0] > compacted[-1] or f == (compacted[-1], True)]


def open_versions(spark: SparkSession, root: str, schema: StructType, before: datetime | None = None) -> DataFrame | None:
    """The open versions after the newest load, or the newest ``before`` a time; None before the first."""
    finished = [f for f in _finished(spark, root) if before is None or f[0] < _version(before)]
    if not finished:
        return None
    return _stored(spark, root, schema, finished[-1:]).where("is_open").select(schema.names)


def read_history(spark: SparkSession, root: str, schema: StructType) -> DataFrame | None:
    """All versions: the open ones of the newest load, and what each load closed; None before the first."""
    finished = _since_compaction(_finished(spark, root))
    if not finished:
        return None
    newest = finished[-1][0] + ("-compacted" if finished[-1][1] else "")
    rows = _stored(spark, root, schema, finished)
    return rows.where(~F.col("is_open") | (F.col("version") == newest)).select(schema.names)


def compact_history(spark: SparkSession, root: str, schema: StructType) -> None:
    """Write the whole history into one folder, which readers take from then on; earlier folders stay for running reads."""
    finished = _finished(spark, root)
    if not finished or finished[-1][1]:
        return
    version = finished[-1][0]
    rows = read_history(spark, root, schema).withColumn("is_open", F.col("valid_to").isNull())
    rows.write.mode("overwrite").partitionBy("is_open").parquet(f"{root}/version={version}-compacted")
    _mark(spark, root, version, compacted=True)
