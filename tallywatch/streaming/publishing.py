"""Batches to a table of any format, each row once however often a batch is repeated.

Most formats can only append, and an append may stop half-way or be repeated
after it was done. So a batch is staged first, each row with its number; a
repeated batch publishes what was staged, not what it computes anew. Marks in a
ledger by run and batch say how far it came. Where an earlier try began to
publish, the rows that the target already holds are looked up and only the
others appended; target rows carry run, batch and number for that.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.operators.scoring import as_score_table
from tallywatch.sources import folders
from tallywatch.sources.score_store import BATCH_COLUMN, RUN_COLUMN
from tallywatch.streaming.sinks import BatchWriter, run_of

ROW_COLUMN = "row_id"
STAGED, BEGUN, DONE = "staged", "begun", "done"


@dataclass(frozen=True)
class Target:
    """A table of any installed format that can be read and appended to."""

    fmt: str
    options: dict[str, str] = field(default_factory=dict)

    def append(self, rows: DataFrame) -> None:
        rows.write.format(self.fmt).options(**self.options).mode("append").save()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format(self.fmt).options(**self.options).load()


class Ledger:
    """How far each batch of each run has come; a mark is written as a whole or not at all."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _mark(self, run: str, batch_id: int, state: str) -> str:
        return f"{self.path}/{RUN_COLUMN}={run}/{BATCH_COLUMN}={batch_id}/state={state}"

    def holds(self, run: str, batch_id: int, state: str) -> bool:
        return folders.is_complete(self.spark, self._mark(run, batch_id, state))

    def enter(self, run: str, batch_id: int, state: str) -> None:
        moment = self.spark.range(1).select(F.current_timestamp().alias("entered"))
        moment.write.mode("overwrite").parquet(self._mark(run, batch_id, state))

    def read(self) -> DataFrame:
        """``run_id``, ``batch_id``, ``state`` and the time it was ``entered``."""
        return self.spark.read.schema(
            f"entered timestamp, {RUN_COLUMN} string, {BATCH_COLUMN} long, state string"
        ).parquet(self.path)


def publish_batch(
    batch: DataFrame,
    batch_id: int,
    run: str,
    target: Target,
    path: str,
    shape: Callable[[DataFrame], DataFrame] = as_score_table,
) -> None:
    """Append a batch to ``target`` unless it is there; ``path`` holds the ledger and staged rows."""
    spark = batch.sparkSession
    ledger = Ledger(spark, f"{path}/ledger")
    if ledger.holds(run, batch_id, DONE):
        return
    staged = f"{path}/staged/{run}/{batch_id}"
    if not ledger.holds(run, batch_id, STAGED):
        shape(batch).withColumn(ROW_COLUMN, F.monotonically_increasing_id()).write.mode("overwrite").parquet(staged)
        ledger.enter(run, batch_id, STAGED)
    rows = spark.read.parquet(staged).withColumns({RUN_COLUMN: F.lit(run), BATCH_COLUMN: F.lit(batch_id).cast("long")})
    if ledger.holds(run, batch_id, BEGUN):
        rows = rows.join(_published_numbers(spark, target, run, batch_id), ROW_COLUMN, "left_anti").select(rows.columns)
    ledger.enter(run, batch_id, BEGUN)
    target.append(rows)
    ledger.enter(run, batch_id, DONE)
    folders.remove(spark, [staged])


def _published_numbers(spark: SparkSession, target: Target, run: str, batch_id: int) -> DataFrame:
    try:
        held = target.read(spark)
    except AnalysisException:
        # the earlier try stopped before the target was made
        return spark.createDataFrame([], f"{ROW_COLUMN} long")
    return held.filter((F.col(RUN_COLUMN) == run) & (F.col(BATCH_COLUMN) == batch_id)).select(ROW_COLUMN)


def publishing_writer(
    target: Target, path: str, shape: Callable[[DataFrame], DataFrame] = as_score_table
) -> BatchWriter:
    """A batch writer for streams over ``publish_batch``; the run is the stream's id."""
    return lambda batch, batch_id: publish_batch(batch, batch_id, run_of(batch), target, path, shape)
