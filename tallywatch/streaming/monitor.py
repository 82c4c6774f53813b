"""Health of running streaming queries."""

from __future__ import annotations

import json
import logging
from collections import deque

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)

PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("rows_per_second", T.DoubleType()),
        T.StructField("batch_ms", T.LongType()),
        T.StructField("state_rows", T.LongType()),
        T.StructField("late_rows_dropped", T.LongType()),
    ]
)
OFFSET_SCHEMA = T.StructType(
    [
        T.StructField("group", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("committed", T.LongType()),
        T.StructField("high", T.LongType()),
    ]
)


def progress_row(progress) -> tuple:
    """One metrics row of a query's progress report."""
    state = progress.stateOperators
    return (
        progress.name or str(progress.id),
        progress.batchId,
        progress.numInputRows,
        float(progress.processedRowsPerSecond),
        progress.durationMs.get("triggerExecution", 0),
        sum(s.numRowsTotal for s in state),
        sum(s.numRowsDroppedByWatermark for s in state),
    )


def offset_rows(progress) -> list[tuple]:
    """Offsets per topic partition of Kafka sources in a progress report."""
    rows = []
    for source in progress.sources:
        try:
            done, latest = json.loads(source.endOffset), json.loads(source.latestOffset)
        except (TypeError, ValueError):
            continue
        if not isinstance(done, dict):
            continue
        for topic, partitions in done.items():
            if not isinstance(partitions, dict):
                continue
            for partition, committed in partitions.items():
                high = (latest or {}).get(topic, {}).get(partition, committed)
                rows.append((progress.name or str(progress.id), topic, int(partition), committed, high))
    return rows


class ProgressLog(StreamingQueryListener):
    """Keeps the latest reports of every query, a bounded number each."""

    def __init__(self, keep: int = 1000):
        self.keep = keep
        self._rows: dict[str, deque[tuple]] = {}
        self._offsets: dict[str, list[tuple]] = {}
        self.failed: list[tuple[str, str]] = []

    def onQueryStarted(self, event) -> None:
        log.info("query %s started", event.id)

    def onQueryProgress(self, event) -> None:
        query = str(event.progress.id)
        self._rows.setdefault(query, deque(maxlen=self.keep)).append(progress_row(event.progress))
        found = offset_rows(event.progress)
        if found:
            self._offsets[query] = found

    @property
    def rows(self) -> list[tuple]:
        return [row for reports in list(self._rows.values()) for row in list(reports)]

    @property
    def offsets(self) -> list[tuple]:
        """The latest offsets of every query."""
        return [row for latest in list(self._offsets.values()) for row in latest]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failed.append((str(event.id), event.exception))

    def progress(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, PROGRESS_SCHEMA)

    def offset_table(self, spark: SparkSession) -> DataFrame:
        """Input of the lag measure."""
        return spark.createDataFrame(self.offsets, OFFSET_SCHEMA)


def stream_metrics(progress: DataFrame) -> DataFrame:
    """Latest report of each query as (name, value) metrics."""
    latest = progress.groupBy("query").agg(F.max_by(F.struct("*"), "batch_id").alias("r")).select("r.*")
    names = ["input_rows", "rows_per_second", "batch_ms", "state_rows", "late_rows_dropped"]
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in names])
    return latest.select("query", F.inline(pairs))


def count_deliveries(tagged: DataFrame, observation: Observation | str = "ingest") -> DataFrame:
    """Attaches accepted and rejected counters: an observation reads them for
    one action, a query listener by name for every batch."""
    return tagged.observe(
        observation,
        F.count_if(F.col("error").isNull()).alias("messages_sent"),
        F.count_if(F.col("error").isNotNull()).alias("messages_failed"),
    )
