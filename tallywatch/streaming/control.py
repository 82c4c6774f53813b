"""Ending a streaming query between two batches."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallywatch.sources import folders
from tallywatch.streaming.sinks import BatchWriter

log = logging.getLogger(__name__)
CLOSED = "closed between batches"


class BatchGate:
    """Lets batches pass until it is closed; closing waits for the batch that is being written.

    A batch that comes to a closed gate has written nothing and is not committed, so the next
    run on the same checkpoint starts with it.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self.closed = False
        self.last: int | None = None

    def guard(self, writer: BatchWriter) -> BatchWriter:
        def write(batch: DataFrame, batch_id: int) -> None:
            with self._lock:
                if self.closed:
                    raise RuntimeError(CLOSED)
                writer(batch, batch_id)
                self.last = batch_id

        return write

    def close(self) -> None:
        with self._lock:
            self.closed = True


def _committed(query: StreamingQuery, batch_id: int | None) -> bool:
    """Whether the query reported the batch, which it does after the commit."""
    progress = query.lastProgress
    return batch_id is None or (progress is not None and progress["batchId"] >= batch_id)


def stop_between_batches(query: StreamingQuery, gate: BatchGate, poll_sec: float = 0.05) -> int | None:
    """Stop a query whose writer ``gate`` guards; the last batch it committed in this run, if any.

    The batch in progress is written and committed first. A query that fails of itself
    raises its own exception.
    """
    gate.close()
    while query.isActive and not _committed(query, gate.last):
        time.sleep(poll_sec)
    query.stop()
    failure = query.exception()
    if failure is not None and CLOSED not in str(failure):
        raise failure
    log.info("query %s stopped after batch %s", query.id, gate.last)
    return gate.last


def marker(spark: SparkSession, path: str) -> Callable[[], bool]:
    """A stop is wanted once ``path`` is there, on whatever file system holds it."""
    return lambda: folders.exists(spark, path)


def run_until(
    query: StreamingQuery,
    gate: BatchGate,
    wanted: Callable[[], bool],
    poll_sec: float = 1.0,
    every: Callable[[], None] | None = None,
    every_sec: float = 30.0,
) -> int | None:
    """Wait for a query until it ends or ``wanted`` says so, then stop it between batches.

    ``every`` is called once per ``every_sec`` meanwhile; its failures are logged and do not
    end the query.
    """
    due = time.monotonic() + every_sec
    while not wanted():
        try:
            if query.awaitTermination(poll_sec):
                return gate.last
        except StreamingQueryException as failure:
            if gate.closed and CLOSED in str(failure):
                return gate.last
            raise
        if every is not None and time.monotonic() >= due:
            due = time.monotonic() + every_sec
            try:
                every()
            except Exception:
                log.exception("periodic call failed")
    return stop_between_batches(query, gate)
