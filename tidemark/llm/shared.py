"""Tables and files in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


@cache
def _package() -> str:
    """This package as a zip file."""
    top = Path(__file__).resolve().parent.parent
    path = f"{tempfile.mkdtemp(prefix='tidemark-')}/{top.name}.zip"
    with zipfile.ZipFile(path, "w") as packed:
        for source in sorted(top.rglob("*.py")):
            packed.write(source, source.relative_to(top.parent))
    return path


BATCH_ROWS, BATCH_BYTES = 1_000, "8m"


def ship(spark: SparkSession) -> None:
    """Let Python functions import this package on all executors; Spark serves the file to them.

    Also keeps the batches that go to Python small in this session: each is held by Spark and by the worker, in
    several forms, for every task of an executor.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if not any(path.endswith(Path(_package()).name) for path in context._python_includes):
        context.addPyFile(_package())


def folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; without that setting a local one, for local sessions only."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _own_folder()
    return f"{base}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder: computed once, safe against lost executors."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_remainder(column: str, modulus: int) -> Column:
    """crc32 of a number as text, modulo ``modulus``; a null counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def partitions(spark: SparkSession, per_partition: int = 1) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions")) * per_partition
