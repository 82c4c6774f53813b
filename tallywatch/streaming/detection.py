"""The streaming detection job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywatch.config import DetectionConfig
from tallywatch.operators.scoring import score_windows
from tallywatch.operators.window_features import direct_window_features
from tallywatch.sources.messages import dead_letters, parse_transactions, with_rejection
from tallywatch.streaming.sinks import BatchWriter


def streaming_features(
    transactions: DataFrame,
    cfg: DetectionConfig = DetectionConfig(),
    once_per_id: bool = False,
    approximate: bool = False,
) -> DataFrame:
    """Window features of a stream; a window is final when the watermark
    passes its end. ``once_per_id`` drops repeats of a transaction that arrive
    within the watermark, ``approximate`` counts countries by a sketch, which
    bounds the state of a window and user."""
    marked = transactions.withWatermark("event_time", cfg.window.watermark)
    if once_per_id:
        marked = marked.dropDuplicatesWithinWatermark(["transaction_id"])
    return direct_window_features(marked, cfg.window, approximate)


def streaming_scores(
    messages: DataFrame, cfg: DetectionConfig = DetectionConfig(), once_per_id: bool = False
) -> DataFrame:
    return score_windows(streaming_features(parse_transactions(messages), cfg, once_per_id), cfg.score)


def start(
    rows: DataFrame,
    writer: BatchWriter,
    checkpoint: str,
    cfg: DetectionConfig = DetectionConfig(),
    available_now: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query in append mode that hands each batch to ``writer``.

    ``available_now`` works off what is there and stops; otherwise batches
    follow the configured interval. Restarting on the same checkpoint resumes.
    """
    out = rows.writeStream.outputMode("append").foreachBatch(writer).option("checkpointLocation", checkpoint)
    if name:
        out = out.queryName(name)
    out = (
        out.trigger(availableNow=True)
        if available_now
        else out.trigger(processingTime=cfg.stream.trigger_interval)
    )
    return out.start()


def start_detection(
    messages: DataFrame,
    writer: BatchWriter,
    checkpoint: str,
    cfg: DetectionConfig = DetectionConfig(),
    available_now: bool = False,
    once_per_id: bool = False,
) -> StreamingQuery:
    """Messages to scored windows."""
    return start(streaming_scores(messages, cfg, once_per_id), writer, checkpoint, cfg, available_now)


def start_dead_letters(
    messages: DataFrame,
    writer: BatchWriter,
    checkpoint: str,
    cfg: DetectionConfig = DetectionConfig(),
    available_now: bool = False,
) -> StreamingQuery:
    """Messages that cannot be scored, to their own table."""
    rejected = dead_letters(with_rejection(messages), cfg.stream.topic)
    return start(rejected, writer, checkpoint, cfg, available_now)


def anomaly_writer(forest, writer: BatchWriter) -> BatchWriter:
    """Adds the forest's score to each batch of feature rows, then writes it.

    The model is read and broadcast once, when the writer is made.
    """
    from tallywatch.operators.transaction_features import feature_vector

    add_score = forest.scorer()

    def write(batch: DataFrame, batch_id: int) -> None:
        writer(add_score(feature_vector(batch)).drop("features"), batch_id)

    return write


def closed_windows(windows: DataFrame, last_event, cfg: DetectionConfig = DetectionConfig()) -> DataFrame:
    """Windows a stream has emitted once it has seen ``last_event``."""
    return windows.filter(F.col("window_end") <= last_event - F.expr(f"INTERVAL {cfg.window.watermark}"))
