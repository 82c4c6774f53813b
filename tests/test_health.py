from __future__ import annotations

import json
from datetime import datetime
from types import SimpleNamespace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywatch.operators import health
from tallywatch.streaming.monitor import OFFSET_SCHEMA, PROGRESS_SCHEMA, ProgressLog, offset_rows, progress_row, stream_metrics


def test_lag_ignores_missing_and_negative(spark):
    rows = [("g", "t", 0, -1, 100), ("g", "t", 1, 120, 100), ("g", "t", 2, 60, 100), ("h", "t", 0, -1, 5)]
    got = {r["group"]: r["lag"] for r in health.offset_lag(spark.createDataFrame(rows, OFFSET_SCHEMA)).collect()}
    assert got == {"g": 40, "h": 0}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-1, 50), st.integers(0, 50)), min_size=1, max_size=10))
def test_lag_is_never_negative(spark, pairs):
    rows = [("g", "t", i, committed, high) for i, (committed, high) in enumerate(pairs)]
    lag = health.offset_lag(spark.createDataFrame(rows, OFFSET_SCHEMA)).first()["lag"]
    assert lag == sum(max(0, h - c) for c, h in pairs if c >= 0)


def test_cost_of_one_user_and_hour(spark):
    schema = "user_name string, start_time timestamp_ntz, credits double, elapsed_ms double, bytes_scanned double"
    rows = [
        ("me", datetime(2024, 1, 1, 11, 30), 0.123456, 10.0, 2.5e9),
        ("me", datetime(2024, 1, 1, 11, 0), None, 25.26, None),
        ("me", datetime(2024, 1, 1, 10, 59), 9.0, 9.0, 9e9),
        ("you", datetime(2024, 1, 1, 11, 30), 9.0, 9.0, 9e9),
    ]
    at = F.lit(datetime(2024, 1, 1, 12)).cast("timestamp_ntz")
    data = spark.createDataFrame(rows, schema)
    assert tuple(health.query_cost_summary(data, "me", at).first()) == (2, 0.1235, 17.6, 25.3, 2.5)
    assert tuple(health.query_cost_summary(data, "nobody", at).first()) == (0, 0.0, 0.0, 0.0, 0.0)


def test_histogram_is_cumulative(spark):
    data = spark.createDataFrame([(0.001,), (0.002,), (0.3,), (5.0,), (None,)], "s double")
    got = {r["le"]: r["cumulative_count"] for r in health.latency_histogram(data, F.col("s")).collect()}
    assert got == {"0.001": 1, "0.005": 2, "0.01": 2, "0.025": 2, "0.05": 2, "0.1": 2, "0.25": 2, "0.5": 3, "1.0": 3, "+Inf": 4}


def test_thresholds_are_strict(spark):
    metrics = [("kafka_lag", 5000.0), ("dlq_count", 6.0), ("fraud_rate", 0.0005), ("avg_detection_latency_ms", 2001.0)]
    alerts = health.evaluate_thresholds(
        spark.createDataFrame(metrics, "name string, value double"), health.monitor_rules(spark)
    ).collect()
    assert {(r["name"], r["severity"]) for r in alerts} == {
        ("dlq_count", "critical"),
        ("fraud_rate", "warning"),
        ("avg_detection_latency_ms", "warning"),
    }
    message = next(r["message"] for r in alerts if r["name"] == "dlq_count")
    assert message == "DLQ_COUNT ALERT: 6.000 is above the limit 5.000"


TAGGED = "kafka_timestamp timestamp, error string"


def test_report_of_nothing(spark):
    """No offsets at all are an unknown lag, not a lag of zero."""
    lag = spark.createDataFrame([], "group string, lag long")
    row = health.health_report(lag, spark.createDataFrame([], TAGGED)).first()
    assert (row["kafka_lag"], row["dlq_count"]) == (-1, 0)


def test_report_counts_rejects_of_the_last_interval_and_one_group(spark):
    at = datetime(2024, 1, 1, 12)
    rows = [(datetime(2024, 1, 1, 11, 59, s), e) for s, e in ((30, "old"), (31, "bad"), (45, None), (59, "bad"))]
    rows += [(at, "bad"), (datetime(2024, 1, 1, 12, 0, 1), "later"), (None, "bad")]
    lag = spark.createDataFrame([("a", 7), ("b", 5)], "group string, lag long")
    tagged = spark.createDataFrame(rows, TAGGED)
    both = health.health_report(lag, tagged, F.lit(at)).first()
    assert (both["kafka_lag"], both["dlq_count"]) == (12, 3)
    one = health.health_report(lag, tagged, F.lit(at), group="a").first()
    assert (one["kafka_lag"], one["dlq_count"]) == (7, 3)
    assert health.health_report(lag, tagged, F.lit(at), group="c").first()["kafka_lag"] == -1


@pytest.mark.parametrize(("rate", "fires"), [(0.05, {"<"}), (10.0, set()), (25.0, {">"}), (None, set())])
def test_fraud_rate_is_fed_to_the_checks(spark, rate, fires):
    kpi = spark.createDataFrame([(rate, 10.0)], "fraud_rate_pct double, avg_detection_latency_ms double")
    alerts = health.evaluate_thresholds(health.fraud_rate_metrics(kpi), health.monitor_rules(spark)).collect()
    assert {r["op"] for r in alerts if r["name"] == "fraud_rate"} == fires


def report(batch, dropped=0):
    return SimpleNamespace(
        name="detect",
        id="1",
        batchId=batch,
        numInputRows=10,
        processedRowsPerSecond=5.0,
        durationMs={"triggerExecution": 2000},
        stateOperators=[SimpleNamespace(numRowsTotal=7, numRowsDroppedByWatermark=dropped)],
        sources=[
            SimpleNamespace(endOffset='{"transactions":{"0":5,"1":7}}', latestOffset='{"transactions":{"0":9,"1":7}}'),
            SimpleNamespace(endOffset="3", latestOffset="3"),
            SimpleNamespace(endOffset=None, latestOffset=None),
        ],
    )


def test_progress_to_metrics_and_lag(spark):
    data = spark.createDataFrame([progress_row(report(1)), progress_row(report(2, dropped=3))], PROGRESS_SCHEMA)
    metrics = {r["name"]: r["value"] for r in stream_metrics(data).collect()}
    assert metrics["late_rows_dropped"] == 3.0 and metrics["batch_ms"] == 2000.0
    offsets = spark.createDataFrame(offset_rows(report(1)), OFFSET_SCHEMA)
    assert health.offset_lag(offsets).first()["lag"] == 4


def test_reports_of_two_queries_do_not_displace_each_other():
    def report(query, batch):
        ends = json.dumps({query: {"0": batch}})
        source = SimpleNamespace(endOffset=ends, latestOffset=ends)
        progress = SimpleNamespace(
            id=query, name=None, batchId=batch, numInputRows=1, processedRowsPerSecond=1.0, durationMs={}, stateOperators=[], sources=[source]
        )
        return SimpleNamespace(progress=progress)

    kept = ProgressLog(keep=2)
    for event in [report("quiet", 0), *[report("busy", batch) for batch in range(5)]]:
        kept.onQueryProgress(event)
    assert [row[:2] for row in kept.rows] == [("quiet", 0), ("busy", 3), ("busy", 4)]
    assert kept.offsets == [("quiet", "quiet", 0, 0, 0), ("busy", "busy", 0, 4, 4)]
