"""Helpers that several operators of this subpackage share.

A word is a maximal run of characters other than space and U+0009 to U+000D
(``WORD``). In UTF-8 those separators are single bytes and exactly the ones
``bytes.split()`` splits at, so tasks work on the raw bytes of a text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.session import save_and_reload, shared_dir

WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["WORD", "column_or_null", "documents", "free_tables", "fresh", "save_and_reload", "shared_dir", "table", "text_bytes", "worker_table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def text_bytes(column: str = "text") -> Column:
    """The UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def fresh(*stems: str) -> tuple[str, ...]:
    """Column names that no input column can clash with."""
    tag = uuid.uuid4().hex[:12]
    return tuple(f"{stem}_{tag}" for stem in stems)


# What a worker keeps from one task of an operator to the next, one table at a time.
_TABLES: dict[str, object] = {}


def worker_table(key: str, make: Callable[[], object]):
    """The worker's table of this key; it is kept until tasks that need room free it or ask for another."""
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = make()
    return _TABLES[key]


def free_tables() -> None:
    """Frees what an earlier stage's tasks left in this worker."""
    _TABLES.clear()
