from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallywatch.operators.health import monitor_rules
from tallywatch.streaming.monitor import ProgressLog
from tallywatch.streaming.reports import check_health, read_reports, report_alerts, store_report

START = dt.datetime(2024, 5, 1, 23, 59, 0)
REPORT = "report_time timestamp_ntz, kafka_lag long, dlq_count long"


def test_one_report_an_interval(spark, tmp_path):
    path = f"{tmp_path}/reports"
    assert read_reports(spark, path).isEmpty()
    # the third falls into the second's interval and replaces it
    for second, lag, rejected in ((0, 10, 0), (30, 20, 1), (45, 6000, 9), (60, -1, 0)):
        row = (START + dt.timedelta(seconds=second), lag, rejected)
        store_report(spark.createDataFrame([row], REPORT), path, 30.0)
    rows = read_reports(spark, path).sort("report_time").collect()
    assert [(r.kafka_lag, r.dlq_count) for r in rows] == [(10, 0), (6000, 9), (-1, 0)]
    assert [r.kafka_lag for r in read_reports(spark, path, "2024-05-02").collect()] == [-1]
    alerts = report_alerts(read_reports(spark, path), monitor_rules(spark)).collect()
    assert {(r.report_time, r.name, r.value) for r in alerts} == {
        (START + dt.timedelta(seconds=45), "kafka_lag", 6000.0),
        (START + dt.timedelta(seconds=45), "dlq_count", 9.0),
    }


def test_check_of_a_running_pipeline(spark, tmp_path):
    progress = ProgressLog()
    progress._offsets["q"] = [("q", "t", 0, 70, 100), ("q", "t", 1, 100, 90)]
    rows = [(START, "bad_json"), (START, None), (START - dt.timedelta(seconds=31), "bad_json")]
    tagged = spark.createDataFrame(rows, "kafka_timestamp timestamp_ntz, error string")
    for _ in range(2):
        check_health(progress, tagged, f"{tmp_path}/r", F.lit(START).cast("timestamp_ntz"))
    assert [tuple(r)[:3] for r in read_reports(spark, f"{tmp_path}/r").collect()] == [(START, 30, 1)]
