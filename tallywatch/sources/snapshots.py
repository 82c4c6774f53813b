"""A score table of many batches whose readers keep their snapshot.

A batch is written as a set of files of its own and then entered in a log;
only what the log names is part of the table. Compaction writes the rows of
crowded dates into few files and enters those in place of the batches' own,
so the number of files follows the data, not the number of batches. Files are
never changed: a reader goes on with those its snapshot names until ``expire``
removes the ones that were replaced long enough ago.

A batch that is written again replaces its earlier attempt, also if that has
been compacted since. One log file is one commit, moved into place as a whole.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.operators.scoring import as_score_table
from tallywatch.schema import SCORE_SCHEMA
from tallywatch.sources import folders
from tallywatch.sources.score_store import BATCH_COLUMN, DATE_COLUMN, NO_RUN, RUN_COLUMN, STORED_SCHEMA

BATCH = [RUN_COLUMN, BATCH_COLUMN]
SET = "file_set"
# the processing date as text, so that rows without one have a day too
DAY = "day"
NO_DAY = "none"
_PLACE = [SET, *BATCH, DAY]

_STORED_ROWS = T.StructType(
    [*SCORE_SCHEMA.fields, T.StructField(RUN_COLUMN, T.StringType()), T.StructField(BATCH_COLUMN, T.LongType()),
     T.StructField(DATE_COLUMN, T.DateType()), T.StructField(SET, T.StringType())]
)
_LOG = T.StructType(
    [T.StructField(RUN_COLUMN, T.StringType()), T.StructField(BATCH_COLUMN, T.LongType()),
     T.StructField(DAY, T.StringType()), T.StructField("attempt", T.LongType()),
     T.StructField("level", T.IntegerType()), T.StructField("rows", T.LongType()), T.StructField(SET, T.StringType())]
)


def _log_path(path: str) -> str:
    return f"{path}/log"


def _set_path(path: str, name: str) -> str:
    return f"{path}/files/{SET}={name}"


def _write_set(rows: DataFrame, path: str) -> str:
    name = uuid.uuid4().hex
    # a task per date, and several for a date too large for one
    rows.hint("rebalance", DATE_COLUMN).write.partitionBy(DATE_COLUMN).parquet(_set_path(path, name))
    return name


def day_of_row() -> Column:
    return F.coalesce(F.col(DATE_COLUMN).cast("string"), F.lit(NO_DAY))


def _enter(entries: DataFrame, path: str) -> None:
    entries.select(_LOG.names).coalesce(1).write.mode("append").parquet(_log_path(path))


def append_batch(scored: DataFrame, path: str, batch_id: int, run: str = NO_RUN) -> None:
    """Add a batch; adding a batch of the same run and number again replaces it."""
    spark = scored.sparkSession
    attempt = time.time_ns()
    named = as_score_table(scored).withColumns(
        {DATE_COLUMN: F.to_date("processed_at"), RUN_COLUMN: F.lit(run), BATCH_COLUMN: F.lit(batch_id).cast("long")}
    )
    name = _write_set(named, path)
    held = _read_sets(spark, path, [name]).groupBy(day_of_row().alias(DAY)).agg(F.count(F.lit(1)).alias("rows"))
    # a batch without rows is entered too: it may replace one that had some
    nothing = spark.range(1).select(F.lit(NO_DAY).alias(DAY), F.lit(0).cast("long").alias("rows"))
    _enter(
        held.unionByName(nothing).withColumns(
            {RUN_COLUMN: F.lit(run), BATCH_COLUMN: F.lit(batch_id).cast("long"), "attempt": F.lit(attempt),
             "level": F.lit(0), SET: F.lit(name)}
        ),
        path,
    )


def _read_sets(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], _STORED_ROWS)
    reader = spark.read.schema(_STORED_ROWS).option("basePath", f"{path}/files")
    return reader.parquet(*[_set_path(path, name) for name in names])


@dataclass(frozen=True)
class Snapshot:
    """The table as the log files listed when it was opened describe it."""

    spark: SparkSession
    path: str
    log: DataFrame

    def entries(self) -> DataFrame:
        """What counts: of each batch its last attempt, of each day of it the last place."""
        own = Window.partitionBy(*BATCH)
        last = self.log.withColumn("last", F.max("attempt").over(own)).where("attempt = last")
        place = F.max(F.struct("level", SET)).alias("place")
        kept = last.groupBy(*BATCH, DAY, "attempt").agg(place, F.max("rows").alias("rows"))
        return kept.select(*BATCH, DAY, "attempt", "place.level", "rows", f"place.{SET}")

    def rows(self, of: DataFrame | None = None) -> DataFrame:
        """The stored rows, or those that the entries ``of`` name."""
        wanted = (self.entries() if of is None else of).where("rows > 0")
        names = sorted(row[0] for row in wanted.select(SET).distinct().collect())
        stored = _read_sets(self.spark, self.path, names)
        if of is not None or self._others(wanted, names):
            # a set may hold batches that were replaced, days that were moved, or what is not asked for
            stored = stored.withColumn(DAY, day_of_row()).join(wanted.select(_PLACE).distinct(), _PLACE, "left_semi")
        return stored.select(STORED_SCHEMA.names)

    def _others(self, wanted: DataFrame, names: list[str]) -> bool:
        inside = self.log.where(F.col(SET).isin(names) & (F.col("rows") > 0)).select(_PLACE).distinct()
        return not inside.join(wanted, _PLACE, "left_anti").isEmpty()


def open_snapshot(spark: SparkSession, path: str) -> Snapshot:
    # files are listed here and not again, so all that follows sees the same commits
    log = spark.read.schema(_LOG).parquet(_log_path(path)) if folders.exists(spark, _log_path(path)) else None
    return Snapshot(spark, path, spark.createDataFrame([], _LOG) if log is None else log)


def compact(spark: SparkSession, path: str, crowded: int = 8) -> int:
    """Merge the files of days that lie in ``crowded`` sets or more; returns how many such days there were.

    The log entry that publishes the new files repeats all others that still
    matter, so older log files can go. Batches that arrive meanwhile are not
    touched.
    """
    now = open_snapshot(spark, path)
    entries = now.entries()
    filled = entries.where("rows > 0")
    sets = filled.groupBy(DAY).agg(F.count_distinct(SET).alias("sets")).where(F.col("sets") >= crowded)
    days = [row[0] for row in sets.select(DAY).collect()]
    if not days:
        return 0
    moved = filled.where(F.col(DAY).isin(days))
    name = _write_set(now.rows(moved).where(day_of_row().isin(days)), path)
    new = moved.withColumns({"level": F.col("level") + 1, SET: F.lit(name)})
    stay = entries.where((F.col("rows") == 0) | ~F.col(DAY).isin(days))
    # batches that were replaced, in sets that stay, must go on being known as such
    replaced = now.log.join(stay.where("rows > 0").select(SET).distinct(), SET, "left_semi")
    parts = [part.select(_LOG.names) for part in (new, stay, replaced)]
    _enter(parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct(), path)
    return len(days)


def expire(spark: SparkSession, path: str, keep_seconds: float) -> tuple[int, int]:
    """Remove sets and log files that were replaced ``keep_seconds`` ago or more.

    Returns how many of each went. Readers that opened their snapshot before
    that lose their files, so keep them longer than any query takes.
    """
    limit = F.timestamp_micros(F.lit(int((time.time() - keep_seconds) * 1e6)))
    log = spark.read.schema(_LOG).parquet(_log_path(path))
    log = log.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("entered"))
    entries = Snapshot(spark, path, log.select(_LOG.names)).entries()
    living = entries.where("rows > 0").select(SET).distinct()
    dead = log.join(living, SET, "left_anti")
    # a set is replaced when the last of its batches is found in a newer place
    newer = log.select(*BATCH, F.col("attempt").alias("a"), F.col("level").alias("l"), F.col("entered").alias("replaced"))
    later = (F.col("a") > F.col("attempt")) | ((F.col("a") == F.col("attempt")) & (F.col("l") > F.col("level")))
    gone = dead.join(newer, BATCH).where(later).groupBy(SET, *BATCH).agg(F.min("replaced").alias("replaced"))
    gone = gone.groupBy(SET).agg(F.max("replaced").alias("replaced")).where(F.col("replaced") <= limit)
    removable = [row[0] for row in gone.select(SET).collect()]
    # a log file may go when the last compaction's repeats all it says of sets that stay
    tops = log.groupBy("file").agg(F.max("entered").alias("at"), F.max("level").alias("top")).where("top > 0")
    checkpoint = tops.agg(F.max_by("file", "at")).first()[0]
    files = []
    if checkpoint:
        key = [*BATCH, DAY, "attempt", SET]
        repeated = log.where(F.col("file") == checkpoint).select(key)
        others = log.where((F.col("file") != checkpoint) & (F.col("entered") <= limit))
        needed = others.where(~F.col(SET).isin(removable)).join(repeated, key, "left_anti").select("file").distinct()
        files = [row[0] for row in others.select("file").distinct().join(needed, "file", "left_anti").collect()]
    folders.remove(spark, [_set_path(path, name) for name in removable] + files)
    return len(removable), len(files)
