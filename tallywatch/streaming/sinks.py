"""Batch sinks for streaming queries, with a fallback and its replay."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.operators.scoring import as_score_table
from tallywatch.sources.score_store import (
    BATCH_COLUMN,
    DATE_COLUMN,
    NO_RUN,
    RUN_COLUMN,
    SCORE_KEY,
    STORED_SCHEMA,
    read_scores,
    write_scores,
)

log = logging.getLogger(__name__)
BatchWriter = Callable[[DataFrame, int], None]


def table_writer(fmt: str, options: dict[str, str]) -> BatchWriter:
    """Appends each batch to an external table of any installed format."""

    def write(batch: DataFrame, batch_id: int) -> None:
        as_score_table(batch).write.format(fmt).options(**options).mode("append").save()

    return write


def run_of(batch: DataFrame) -> str:
    """The id that a stream keeps in its checkpoint, across restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or NO_RUN


def score_writer(path: str) -> BatchWriter:
    return lambda batch, batch_id: write_scores(batch, path, batch_id, run_of(batch))


def with_fallback(writer: BatchWriter, fallback_path: str) -> BatchWriter:
    """Runs ``writer``; a batch it cannot write is kept for replay.

    The batch is persisted while both the count and the writes read it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            log.info("batch %s: %s rows", batch_id, batch.count())
            try:
                writer(batch, batch_id)
            except Exception:
                log.exception("batch %s kept for replay", batch_id)
                write_scores(batch, fallback_path, batch_id, run_of(batch))
        finally:
            batch.unpersist()

    return write


def replay_fallback(spark: SparkSession, fallback_path: str, scores_path: str) -> None:
    """Add kept rows that the score table does not hold yet.

    Only the dates that occur among the kept rows are read from the table, and
    a replayed batch lands under its own batch number, so repeating the replay
    changes nothing.
    """
    kept = spark.read.schema(STORED_SCHEMA).parquet(fallback_path)
    first, last = kept.agg(F.min(DATE_COLUMN), F.max(DATE_COLUMN)).first()
    if first is None:
        return
    held = read_scores(spark, scores_path).filter(F.col(DATE_COLUMN).between(first, last))
    # null-safe: rows without user are held under a null key too
    renamed = held.select(*[F.col(name).alias(f"held_{name}") for name in SCORE_KEY])
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"held_{name}")) for name in SCORE_KEY])
    missing = kept.join(renamed, same, "left_anti")
    (
        missing.withColumn(BATCH_COLUMN, -1 - F.col(BATCH_COLUMN))
        .write.partitionBy(DATE_COLUMN, RUN_COLUMN, BATCH_COLUMN)
        .mode("append")
        .parquet(scores_path)
    )


def batch_folder_writer(path: str) -> BatchWriter:
    """Writes rows as they are, one folder per run and batch, rewritten on retry."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{RUN_COLUMN}={run_of(batch)}/{BATCH_COLUMN}={batch_id}")

    return write
