from __future__ import annotations

import json
import time
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywatch.config import DetectionConfig, ForestConfig, WindowConfig
from tallywatch.operators.isolation_forest import train_isolation_forest
from tallywatch.operators.scoring import score_windows
from tallywatch.operators.transaction_features import behavioral_features, feature_vector
from tallywatch.operators.window_features import window_features
from tallywatch.sources.messages import MESSAGE_SCHEMA, parse_transactions, read_messages
from tallywatch.sources.score_store import read_scores
from tallywatch.streaming.detection import anomaly_writer, closed_windows, start, start_dead_letters, start_detection
from tallywatch.streaming.monitor import ProgressLog
from tallywatch.streaming.sinks import batch_folder_writer, replay_fallback, score_writer, table_writer, with_fallback
from tallywatch.streaming.stateful import model_inputs, stream_rules, trailing_stream_features

@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


CONFIG = DetectionConfig(window=WindowConfig("1 hour", "20 minutes"))
START = datetime(2024, 1, 1)


def body(number, user, seconds, amount=10.0, country="US"):
    at = (START + timedelta(seconds=seconds)).isoformat(timespec="microseconds") + "+00:00"
    record = {"transaction_id": f"t{number}", "user_id": user, "timestamp": at, "amount": amount, "merchant_country": country}
    return json.dumps(record)


def put(spark, folder, bodies):
    """One more file of messages in the folder a stream watches."""
    rows = [(b"k", b.encode(), START) for b in bodies]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def read(spark, folder):
    return read_messages(spark, "parquet", {"maxFilesPerTrigger": "1"}, path=str(folder))


def some_bodies(first, count, begin, span, seed=0):
    rng = np.random.default_rng(seed)
    return [
        body(first + i, f"u{int(rng.integers(0, 4))}", begin + int(s), round(float(rng.lognormal(3, 1)), 2), str(rng.choice(["US", "UK"])))
        for i, s in enumerate(sorted(rng.integers(0, span, count)))
    ]


def stored(spark, path):
    rows = read_scores(spark, str(path)).drop("processed_at", "processed_date", "run_id", "batch_id").toPandas()
    return rows.sort_values(["user_id", "window_start"]).reset_index(drop=True)


def in_batch(spark, folder):
    tx = parse_transactions(spark.read.schema(MESSAGE_SCHEMA).parquet(str(folder)))
    tx = tx.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    last = tx.agg(F.max("event_time").alias("m")).scalar()
    windows = closed_windows(score_windows(window_features(tx, CONFIG.window), CONFIG.score), last, CONFIG)
    return windows.drop("processed_at").toPandas().sort_values(["user_id", "window_start"]).reset_index(drop=True)


def run(spark, tmp_path, writer=None, **options):
    writer = writer or with_fallback(score_writer(str(tmp_path / "scores")), str(tmp_path / "fallback"))
    query = start_detection(read(spark, tmp_path / "in"), writer, str(tmp_path / "ck"), CONFIG, available_now=True, **options)
    query.awaitTermination()
    return query


def test_stream_equals_batch_across_a_restart(spark, tmp_path):
    put(spark, tmp_path / "in", some_bodies(0, 150, 0, 7200, 1))
    run(spark, tmp_path)
    before = len(stored(spark, tmp_path / "scores"))
    put(spark, tmp_path / "in", some_bodies(150, 150, 7200, 7200, 2))
    run(spark, tmp_path)
    got, wanted = stored(spark, tmp_path / "scores"), in_batch(spark, tmp_path / "in")
    assert 0 < before < len(got)
    pd.testing.assert_frame_equal(got[wanted.columns], wanted, rtol=1e-9)


def test_late_rows(spark, tmp_path):
    """A row within the watermark counts; one for a closed window does not."""
    put(spark, tmp_path / "in", [body(0, "u", 60), body(1, "u", 7200)])
    run(spark, tmp_path)
    put(spark, tmp_path / "in", [body(2, "u", 7200 - 500), body(3, "u", 120)])
    run(spark, tmp_path)
    put(spark, tmp_path / "in", [body(4, "u", 40_000)])
    query = run(spark, tmp_path)
    assert query.exception() is None
    got = stored(spark, tmp_path / "scores").set_index("window_start")["txn_count_1h"]
    assert got[pd.Timestamp("2024-01-01 00:00:00")] == 1
    assert got[pd.Timestamp("2024-01-01 01:20:00")] == 2


def test_repeats_within_the_watermark_count_once(spark, tmp_path):
    put(spark, tmp_path / "in", [body(0, "u", 60), body(0, "u", 60), body(1, "u", 90)])
    put(spark, tmp_path / "in", [body(1, "u", 90), body(2, "u", 40_000)])
    run(spark, tmp_path, once_per_id=True)
    got = stored(spark, tmp_path / "scores").set_index("window_start")["txn_count_1h"]
    assert got[pd.Timestamp("2024-01-01 00:00:00")] == 2


def test_fallback_and_replay_equal_a_direct_write(spark, tmp_path):
    bodies = some_bodies(0, 120, 0, 14_400, 4)
    put(spark, tmp_path / "in", bodies)
    run(spark, tmp_path)
    direct = stored(spark, tmp_path / "scores")

    other = tmp_path / "other"
    put(spark, other / "in", bodies)

    def half_then_fail(batch, batch_id):
        score_writer(str(other / "scores"))(batch.filter("user_id IN ('u0', 'u1')"), batch_id)
        raise OSError("target is down")

    query = run(spark, other, with_fallback(half_then_fail, str(other / "fallback")))
    assert query.exception() is None
    assert 0 < len(stored(spark, other / "scores")) < len(direct)
    replay_fallback(spark, str(other / "fallback"), str(other / "scores"))
    pd.testing.assert_frame_equal(stored(spark, other / "scores"), direct, rtol=1e-9)
    replay_fallback(spark, str(other / "fallback"), str(other / "scores"))
    assert len(stored(spark, other / "scores")) == len(direct)


def test_two_streams_share_a_store(spark, tmp_path):
    """Batch numbers of a second checkpoint start at 0 again and replace nothing."""
    writer = score_writer(str(tmp_path / "scores"))
    for name in ("first", "second"):
        put(spark, tmp_path / name / "in", [body(0, name, 60), body(1, name, 40_000)])
        run(spark, tmp_path / name, writer)
    got = read_scores(spark, str(tmp_path / "scores"))
    assert {r["user_id"] for r in got.collect()} == {"first", "second"}
    assert got.select("run_id").distinct().count() == 2


def test_any_installed_format_can_be_a_sink(spark, tmp_path):
    put(spark, tmp_path / "in", some_bodies(0, 60, 0, 14_400, 4))
    run(spark, tmp_path, table_writer("json", {"path": str(tmp_path / "json")}))
    assert spark.read.json(str(tmp_path / "json")).count() == len(in_batch(spark, tmp_path / "in"))


def test_dead_letters_and_progress(spark, tmp_path):
    put(spark, tmp_path / "in", [body(0, "u", 1), "{bad", body(1, "u", 2, amount=-5.0)])
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        query = start_dead_letters(
            read(spark, tmp_path / "in"), batch_folder_writer(str(tmp_path / "dlq")), str(tmp_path / "ck"), available_now=True
        )
        query.awaitTermination()
        for _ in range(50):
            if log.rows:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    rows = spark.read.parquet(str(tmp_path / "dlq")).collect()
    assert sorted(r["error"] for r in rows) == ["invalid_amount", "malformed_json"]
    assert log.progress(spark).agg(F.sum("input_rows")).first()[0] == 3


def stateful(spark, tmp_path):
    tx = parse_transactions(read(spark, tmp_path / "in"))
    query = start(
        stream_rules(trailing_stream_features(tx)),
        batch_folder_writer(str(tmp_path / "rows")),
        str(tmp_path / "ck"),
        available_now=True,
    )
    query.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "rows")).toPandas()
    return rows.sort_values("transaction_id").reset_index(drop=True)


def past_of(rows, row, hours=0, minutes=0):
    low = row.event_time - pd.Timedelta(hours=hours, minutes=minutes)
    return rows[(rows.user_id == row.user_id) & (rows.event_time > low) & (rows.event_time <= row.event_time)]


def test_stateful_features_over_several_batches(spark, tmp_path):
    """Seven batches over three days, a restart, and late rows at the end."""
    batches = [some_bodies(i * 80, 80, i * 36_000, 36_000, i) for i in range(6)]
    batches.append([body(9000, "u1", 6 * 36_000 + 400), body(9001, "u1", 6 * 36_000 + 100), body(9002, "u1", 6 * 36_000 + 400)])
    for bodies in batches[:4]:
        put(spark, tmp_path / "in", bodies)
    assert len(stateful(spark, tmp_path)) == 320
    for bodies in batches[4:]:
        put(spark, tmp_path / "in", bodies)
    got = stateful(spark, tmp_path)
    assert len(got) == 483
    for row in got.itertuples():
        hour, day, minute = past_of(got, row, hours=1), past_of(got, row, hours=24), past_of(got, row, minutes=1)
        assert row.txn_count_1h == len(hour) and row.txn_count_24h == len(day)
        assert row.total_amount_1h == pytest.approx(hour.amount.sum())
        assert row.avg_amount_1h == pytest.approx(hour.amount.mean())
        assert row.stddev_amount_1h == pytest.approx(0.0 if len(hour) == 1 else hour.amount.std())
        assert row.max_amount_1h == hour.amount.max()
        assert row.burst_amount == pytest.approx(minute.amount.sum())
        assert row.country_count_24h == day.merchant_country.nunique()
        assert row.rule_country_spread == (day.merchant_country.nunique() > 5)
        today = day[day.event_time.dt.date == row.event_time.date()]
        assert row.country_count_1h == today.merchant_country.nunique()
        mine = got[got.user_id == row.user_id].sort_values(["event_time", "transaction_id"])
        upto = mine[(mine.event_time < row.event_time) | ((mine.event_time == row.event_time) & (mine.transaction_id <= row.transaction_id))]
        last = upto.amount.iloc[-100:]
        if len(last) < 10:
            assert pd.isna(row.zscore_amount)
        else:
            assert row.zscore_amount == pytest.approx((row.amount - last.mean()) / (last.std() + 1e-9), abs=1e-9)


def test_forest_scores_a_stream(spark, tmp_path):
    put(spark, tmp_path / "in", some_bodies(0, 300, 0, 80_000, 3))
    tx = parse_transactions(read(spark, tmp_path / "in")).fillna(False, ["card_present", "is_high_risk_merchant"])
    history = parse_transactions(spark.read.schema(MESSAGE_SCHEMA).parquet(str(tmp_path / "in")))
    history = history.fillna(False, ["card_present", "is_high_risk_merchant"])
    trained = feature_vector(behavioral_features(history)).select("transaction_id", "features")
    forest = train_isolation_forest(trained, "transaction_id", cfg=ForestConfig(trees=20))
    writer = anomaly_writer(forest, batch_folder_writer(str(tmp_path / "rows")))
    start(model_inputs(trailing_stream_features(tx)), writer, str(tmp_path / "ck"), available_now=True).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "rows")).toPandas()
    assert len(rows) == 300 and rows["isolation_score"].between(-1, 0, inclusive="left").all()
    assert 0 < rows["is_anomaly_ml"].sum() < 60
