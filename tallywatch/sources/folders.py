"""Folders of the store that the session reads and writes, whatever file system holds them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    path, files = _path(spark, path)
    return files.exists(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True for a folder that a write has finished."""
    return exists(spark, f"{path}/_SUCCESS")


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove files or whole folders; those that are gone already are passed over."""
    for name in paths:
        path, files = _path(spark, name)
        files.delete(path, True)
