from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from tallywatch.config import WindowConfig
from tallywatch.operators.scoring import zscore_flags
from tallywatch.operators.window_features import direct_window_features, non_overlapping, window_features

SCHEMA = "transaction_id string, user_id string, event_time timestamp_ntz, amount double, merchant_country string"
START = datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(
        [(f"t{i}", u, START + timedelta(seconds=s), a, c) for i, (u, s, a, c) in enumerate(rows)], SCHEMA
    )


def ordered(df):
    return df.toPandas().sort_values(["user_id", "window_start"]).reset_index(drop=True)


def test_one_row_has_no_spread_and_twelve_windows(spark):
    got = ordered(window_features(frame(spark, [("u", 60, 10.0, None)])))
    assert len(got) == 12
    assert got["stddev_amount_1h"].isna().all()
    assert (got["country_count_1h"] == 0).all()
    assert (got["window_end"] - got["window_start"] == pd.Timedelta("1h")).all()
    assert got["window_start"].min() == pd.Timestamp("2023-12-31 23:05:00")


def test_equal_amounts_have_zero_spread(spark):
    got = ordered(window_features(frame(spark, [("u", i * 400, 0.1, "US") for i in range(9)])))
    spread = got.loc[got["txn_count_1h"] > 1, "stddev_amount_1h"]
    assert (spread == 0.0).all()
    assert (zscore_flags(window_features(frame(spark, [("u", i, 0.1, "US") for i in range(9)]))).toPandas()["zscore_amount"] == 0.0).all()


@pytest.mark.parametrize("count, flagged", [(10, False), (11, True)])
def test_flag_needs_eleven_rows(spark, count, flagged):
    rows = [("u", i, 1.0, "US") for i in range(count - 1)] + [("u", count, 1000.0, "US")]
    got = zscore_flags(window_features(frame(spark, rows))).toPandas()
    assert got["zscore_fraud_flag"].all() == flagged
    assert (got["zscore_amount"] <= (count - 1) / np.sqrt(count) + 1e-9).all()


@pytest.mark.parametrize("cfg", [WindowConfig(), WindowConfig("1 hour", "20 minutes"), WindowConfig("30 minutes", "30 minutes")])
def test_panes_equal_direct_windows(spark, cfg):
    rng = np.random.default_rng(7)
    rows = [
        (f"u{min(int(rng.integers(0, 9)), 3)}", int(rng.integers(0, 20_000)), float(rng.lognormal(3, 1)), str(rng.choice(["US", "UK", "DE"])))
        for _ in range(600)
    ]
    data = frame(spark, rows)
    panes, direct = ordered(window_features(data, cfg)), ordered(direct_window_features(data, cfg))
    pd.testing.assert_frame_equal(panes, direct[panes.columns], rtol=1e-9)


def test_slide_that_does_not_divide(spark):
    cfg = WindowConfig("1 hour", "25 minutes")
    data = frame(spark, [("u", i * 300, float(i), "US") for i in range(40)])
    pd.testing.assert_frame_equal(ordered(window_features(data, cfg)), ordered(direct_window_features(data, cfg)))


def test_spread_survives_large_amounts(spark):
    rows = [("u", i * 60, 1e9 + i * 0.01, "US") for i in range(30)]
    got = ordered(window_features(frame(spark, rows)))
    full = got[got["txn_count_1h"] == 30].iloc[0]
    assert full["stddev_amount_1h"] == pytest.approx(np.std([1e9 + i * 0.01 for i in range(30)], ddof=1), rel=1e-5)


def test_non_overlapping_counts_once(spark):
    data = frame(spark, [("u", i * 611, 1.0, "US") for i in range(50)])
    kept = non_overlapping(window_features(data)).toPandas()
    assert kept["txn_count_1h"].sum() == 50


def test_plan_copies_panes_not_rows(spark):
    plan = window_features(frame(spark, [("u", 1, 1.0, "US")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.index("Generate explode") < plan.index("Exchange hashpartitioning")
    assert "ObjectHashAggregate" not in plan


@pytest.mark.parametrize("approximate", [False, True])
def test_windows_are_made_from_sorted_panes_without_a_table_of_windows(spark, approximate):
    data = frame(spark, [("u", 1, 1.0, "US"), ("u", 2, 3.0, None), ("u", 3, 5.0, "DE"), (None, 400, 7.0, "US")])
    made = window_features(data, approximate=approximate)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan[: plan.index("Exchange hashpartitioning")] and plan.count("Sort [") <= (2 if approximate else 1)
    got = made.filter("window_start = '2024-01-01'").collect()
    assert {(r.user_id, r.txn_count_1h, r.total_amount_1h, r.country_count_1h) for r in got} == {("u", 3, 9.0, 2), (None, 1, 7.0, 1)}
