"""Intermediate results written to the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from siltstone.sources.files import delete


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.  Only a local session without one gets a temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="siltstone-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/siltstone/{spark.sparkContext.applicationId}"


#: Paths given out while a ``staging`` block is open, innermost last.
_OPEN: list[list[str]] = []


@contextmanager
def staging() -> Iterator[Callable[[SparkSession], None]]:
    """Inside the block, remember what is staged; the function it gives deletes that."""
    paths: list[str] = []
    _OPEN.append(paths)
    try:
        yield lambda spark: [delete(spark, path) for path in paths] and None
    finally:
        _OPEN.pop()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path not used before in the shared folder."""
    path = f"{_application_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for paths in _OPEN:
        paths.append(path)
    return path


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application has staged.  Frames built on it cannot be read any more."""
    delete(spark, _application_dir(spark))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the frame once and read it back: cuts lineage, survives lost executors, and gives the
    optimizer real sizes for the plans above it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
