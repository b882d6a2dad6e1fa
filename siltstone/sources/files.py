"""Existence, listing and deletion on the file system a path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.exists(p)


def has_children(spark: SparkSession, path: str) -> bool:
    """Whether a folder has anything in it.  Looks at one entry, however many there are."""
    fs, p = _resolve(spark, path)
    return fs.exists(p) and fs.listStatusIterator(p).hasNext()


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file, or leave the one there."""
    fs, p = _resolve(spark, path)
    if not fs.exists(p):
        fs.create(p, False).close()


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _resolve(spark, old)
    if not fs.rename(p, _resolve(spark, new)[1]):
        raise OSError(f"cannot rename {old} to {new}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children; empty if the folder does not exist."""
    fs, p = _resolve(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    fs.delete(p, True)
