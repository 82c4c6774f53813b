from __future__ import annotations

import time
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException

from tallywatch.streaming.control import BatchGate, marker, run_until, stop_between_batches
from tallywatch.streaming.detection import start

FILES = 8


def stream(spark, folder):
    for part in range(FILES):
        spark.range(part * 10, part * 10 + 10, numPartitions=1).write.parquet(f"{folder}/in/{part}")
    return spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")


def appender(folder, seconds=0.0):
    def append(batch, batch_id):
        time.sleep(seconds)
        batch.write.mode("append").parquet(f"{folder}/out")

    return append


def held(spark, folder):
    return Counter(r.id for r in spark.read.parquet(f"{folder}/out").collect())


def test_stopped_in_mid_stream_and_resumed(spark, tmp_path):
    rows = stream(spark, tmp_path)
    seen = []
    for batches in (1, 3):
        gate = BatchGate()
        query = start(rows, gate.guard(appender(tmp_path, 0.2)), f"{tmp_path}/check", available_now=True)
        seen.append(run_until(query, gate, lambda: (gate.last or 0) >= batches, poll_sec=0.01))
        assert not query.isActive
        # what was written by then is what the next run does not repeat
        assert sum(held(spark, tmp_path).values()) == 10 * (seen[-1] + 1) < 10 * FILES
    assert seen[0] < seen[1]
    gate = BatchGate()
    assert run_until(start(rows, gate.guard(appender(tmp_path)), f"{tmp_path}/check", available_now=True), gate, lambda: False, 0.1) == FILES - 1
    assert held(spark, tmp_path) == Counter(range(10 * FILES))


def test_stop_by_marker_while_idle(spark, tmp_path):
    rows, gate, calls = stream(spark, tmp_path), BatchGate(), []
    query = start(rows, gate.guard(appender(tmp_path)), f"{tmp_path}/check")
    wanted = marker(spark, f"{tmp_path}/stop")

    def periodic():
        calls.append(gate.last)
        if gate.last is not None:
            spark.range(1).write.mode("overwrite").parquet(f"{tmp_path}/stop")
        raise OSError("is logged")

    last = run_until(query, gate, wanted, poll_sec=0.2, every=periodic, every_sec=0.3)
    assert calls and not query.isActive
    assert held(spark, tmp_path) == Counter(range(10 * (last + 1)))


def test_no_batch_passes_a_closed_gate_and_failures_come_through(spark, tmp_path):
    rows, gate = stream(spark, tmp_path), BatchGate()
    gate.close()
    query = start(rows, gate.guard(appender(tmp_path)), f"{tmp_path}/check", available_now=True)
    assert stop_between_batches(query, gate) is None

    def breaks(batch, batch_id):
        raise ValueError("disk is full")

    gate = BatchGate()
    query = start(rows, gate.guard(breaks), f"{tmp_path}/check", available_now=True)
    with pytest.raises(StreamingQueryException, match="disk is full"):
        run_until(query, gate, lambda: False, poll_sec=0.2)
    with pytest.raises(StreamingQueryException, match="disk is full"):
        stop_between_batches(query, gate)
