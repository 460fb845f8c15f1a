"""Folders that the driver and all executors reach."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; without that setting a local one, for local sessions only."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _own_folder()
    return f"{base}/{name}-{uuid.uuid4().hex}"
