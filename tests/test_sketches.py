from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywatch.config import DetectionConfig, WindowConfig
from tallywatch.functions.sketches import (
    RANK_ERROR,
    distinct_error,
    distinct_estimate,
    distinct_sketch,
    merged_distincts,
    merged_quantiles,
    quantile_sketch,
    sketched_quantile,
)
from tallywatch.operators.window_features import window_features
from tallywatch.streaming.detection import start, streaming_features
from tallywatch.streaming.quartiles import add_batch, drop_merged, quartile_bounds, quartile_writer, sketches_upto
from tallywatch.streaming.sinks import batch_folder_writer


def test_merged_sketches_stay_within_their_errors(spark):
    rows = spark.range(200_000).select((F.col("id") % 60_000).alias("v"), (F.col("id") % 7).alias("part"), F.sqrt("id").alias("x"))
    parts = rows.groupBy("part").agg(distinct_sketch(F.col("v")).alias("d"), quantile_sketch(F.col("x")).alias("q"))
    merged = parts.agg(merged_distincts(F.col("d")).alias("d"), merged_quantiles(F.col("q")).alias("q"))
    row = merged.select(distinct_estimate(F.col("d")), F.length("d"), *[sketched_quantile(F.col("q"), r) for r in (0.25, 0.5, 0.75)]).first()
    assert abs(row[0] - 60_000) <= distinct_error() * 60_000 and row[1] < 10_000
    for rank, value in zip((0.25, 0.5, 0.75), row[2:]):
        assert abs(value**2 / 200_000 - rank) <= RANK_ERROR


def test_nulls_and_nothing(spark):
    none = spark.createDataFrame([(None, None)], "v string, x double")
    for rows in (none, none.limit(0)):
        row = rows.agg(distinct_estimate(distinct_sketch(F.col("v"))), sketched_quantile(quantile_sketch(F.col("x")), 0.5)).first()
        assert tuple(row) == (0, None)


def transactions(spark, count=300):
    draw = np.random.default_rng(4)
    begin = datetime(2024, 1, 1)
    rows = [
        (f"t{i}", f"u{int(draw.integers(3))}", begin + timedelta(minutes=int(draw.integers(600))), float(draw.lognormal(3, 1)),
         None if draw.random() < 0.1 else f"c{int(draw.integers(40))}")
        for i in range(count)
    ]
    return spark.createDataFrame(rows, "transaction_id string, user_id string, event_time timestamp, amount double, merchant_country string")


@pytest.mark.parametrize("window", [WindowConfig("1 hour", "20 minutes"), WindowConfig("1 hour", "25 minutes")])
def test_windows_with_sketches_equal_exact_ones_on_few_countries(spark, window):
    tx = transactions(spark).cache()
    counts = [
        sorted(map(tuple, window_features(tx, window, approximate).select("user_id", "window_start", "country_count_1h", "txn_count_1h").collect()))
        for approximate in (False, True)
    ]
    assert counts[0] == counts[1]


def test_stream_with_sketches(spark, tmp_path):
    cfg = DetectionConfig(window=WindowConfig("1 hour", "1 hour"))
    tx = transactions(spark)
    tx.coalesce(1).write.parquet(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        stream = spark.readStream.schema(tx.schema).parquet(f"{tmp_path}/in")
        rows = streaming_features(stream, cfg, approximate=True)
        start(rows, batch_folder_writer(f"{tmp_path}/out"), f"{tmp_path}/check", cfg, available_now=True).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = {(r.user_id, r.window_start): r.country_count_1h for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    want = {(r.user_id, r.window_start): r.country_count_1h for r in window_features(tx, cfg.window).collect()}
    assert len(got) >= 20 and all(want[key] == count for key, count in got.items())


def amounts(draw, first, count):
    return [(first + i, f"u{i % 2}" if i % 50 else None, float(draw.lognormal(3, 1)) if i % 31 else None) for i in range(count)]


SCHEMA = "id long, user_id string, amount double"


def test_quartiles_over_batches(spark, tmp_path):
    draw = np.random.default_rng(1)
    path, seen = str(tmp_path), []
    for number in range(5):
        rows = amounts(draw, 10_000 * number, 3000)
        seen += rows
        batch = spark.createDataFrame(rows, SCHEMA)
        flagged = add_batch(batch, number, "run", path, every=2).collect()
        # a repeated batch counts once; sketches draw anew, which moves few flags
        again = {r.id: r.iqr_outlier for r in add_batch(batch, number, "run", path, every=2).collect()}
        assert np.mean([again[r.id] == r.iqr_outlier for r in flagged]) > 0.98
        held = sketches_upto(spark, path, "run", number, every=2).select(F.sum(F.kll_sketch_get_n_double("sketch"))).first()[0]
        assert held == sum(u is not None and a is not None for _, u, a in seen)
    assert len(flagged) == 3000
    assert all(r.iqr_outlier is None for r in flagged if r.user_id is None)
    assert all(r.iqr_outlier is False for r in flagged if r.user_id and r.amount is None)
    state = sketches_upto(spark, path, "run", 4, every=2)
    bounds = {r.user_id: r for r in quartile_bounds(state).collect()}
    agree = []
    for user in ("u0", "u1"):
        values = np.array([a for _, u, a in seen if u == user and a is not None])
        for rank, quartile in ((0.25, bounds[user].q1), (0.75, bounds[user].q3)):
            assert (values < quartile).mean() <= rank + RANK_ERROR and (values <= quartile).mean() >= rank - RANK_ERROR
        q1, q3 = np.quantile(values, [0.25, 0.75])
        agree += [r.iqr_outlier == (r.amount < q1 - 1.5 * (q3 - q1) or r.amount > q3 + 1.5 * (q3 - q1)) for r in flagged if r.user_id == user and r.amount]
    assert np.mean(agree) > 0.97
    assert max(r.size for r in state.select(F.length("sketch").alias("size")).collect()) < 12_000
    drop_merged(spark, path, "run", 4, every=2)
    assert sorted(n for n in os.listdir(f"{path}/run")) == ["base=3", "part=0", "part=1", "part=4"]
    assert sketches_upto(spark, path, "run", 4, every=2).count() == 2


def test_quartile_stream_restarts(spark, tmp_path):
    draw = np.random.default_rng(2)
    for number in range(3):
        spark.createDataFrame(amounts(draw, 1000 * number, 200), SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(f"{tmp_path}/in")
    writer = quartile_writer(batch_folder_writer(f"{tmp_path}/out"), f"{tmp_path}/state", every=2)

    def broken(batch, number):
        writer(batch, number)
        if number == 1:
            raise OSError("after the write")

    for write in (broken, writer):
        query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        except Exception as error:
            assert "after the write" in str(error)
    rows = spark.read.parquet(f"{tmp_path}/out")
    assert rows.count() == 600 == rows.select("id").distinct().count()
    total = sketches_upto(spark, f"{tmp_path}/state", str(query.id), 2, every=2)
    n = total.select(F.sum(F.kll_sketch_get_n_double("sketch"))).first()[0]
    assert n == rows.where("user_id IS NOT NULL AND amount IS NOT NULL").count()
