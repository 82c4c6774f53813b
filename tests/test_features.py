from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from tallywatch.operators.transaction_features import behavioral_features, feature_vector, iqr_outliers
from tallywatch.operators.transaction_rules import burst_amount_rule, country_spread_rule, geo_velocity
from tallywatch.schema import MODEL_FEATURES
from tallywatch.sources.synthetic import synthetic_transactions


@pytest.fixture(scope="module")
def history(spark):
    """Seeded transactions with few users, one of them with a third of all."""
    made = synthetic_transactions(spark, 900, seed=5, per_second=1)
    return made.selectExpr(
        "transaction_id",
        "CASE WHEN pmod(xxhash64(transaction_id), 3) = 0 THEN 'hot' ELSE concat('u', pmod(xxhash64(transaction_id, 1), 4)) END AS user_id",
        "event_time + make_dt_interval(0, 0, 0, 29 * (minute(event_time) * 60 + second(event_time))) AS event_time",
        "amount",
        "merchant_country",
        "merchant_id",
        "card_present",
        "is_high_risk_merchant",
    )


def by_definition(rows: pd.DataFrame) -> pd.DataFrame:
    """Every value from the rows its definition names, found by a scan of all rows."""
    out = []
    for row in rows.itertuples(index=False):
        mine = rows[rows.user_id == row.user_id]
        hour = mine[(mine.event_time > row.event_time - pd.Timedelta(hours=1)) & (mine.event_time <= row.event_time)].amount
        day = mine[mine.event_time.dt.floor("D") == row.event_time.floor("D")]
        earlier = (mine.event_time < row.event_time) | ((mine.event_time == row.event_time) & (mine.transaction_id <= row.transaction_id))
        last = np.array([amount for *_, amount in sorted(zip(mine.event_time[earlier], mine.transaction_id[earlier], mine.amount[earlier]))][-100:])
        low, high = np.percentile(mine.amount, [25, 75])
        out.append(
            {
                "transaction_id": row.transaction_id,
                "txn_count_1h": len(hour),
                "total_amount_1h": sum(hour),
                "avg_amount_1h": sum(hour) / len(hour),
                "stddev_amount_1h": np.std(hour, ddof=1) if len(hour) > 1 else 0.0,
                "max_amount_1h": max(hour),
                "zscore_amount": (row.amount - last.mean()) / (np.std(last, ddof=1) + 1e-9) if len(last) >= 10 else np.nan,
                "iqr_outlier": int(not low - 1.5 * (high - low) <= row.amount <= high + 1.5 * (high - low)),
                "country_count_1h": len(set(day.merchant_country)),
            }
        )
    return pd.DataFrame(out).sort_values("transaction_id").reset_index(drop=True)


def test_features_equal_their_definitions(history):
    got = behavioral_features(history).toPandas().sort_values("transaction_id").reset_index(drop=True)
    wanted = by_definition(history.toPandas())
    columns = [c for c in wanted.columns if c in got.columns]
    assert len(got) == 900 and "zscore_amount" in columns
    pd.testing.assert_frame_equal(got[columns], wanted[columns], check_dtype=False, rtol=1e-6, atol=1e-6)


def test_vector_order_and_missing_values(history):
    row = feature_vector(behavioral_features(history)).filter("zscore_amount IS NULL").first()
    wanted = [0.0 if row[name] is None else float(row[name]) for name in MODEL_FEATURES]
    assert row["features"] == wanted and len(wanted) == 12


def test_rows_without_user_are_kept(spark):
    rows = spark.createDataFrame([("a", None, 1.0), ("b", "u", 1.0)], "transaction_id string, user_id string, amount double")
    assert {r["transaction_id"]: r["iqr_outlier"] for r in iqr_outliers(rows).collect()} == {"a": 0, "b": 0}


def test_rules(spark):
    rows = spark.sql(
        """SELECT concat('t', i) AS transaction_id, 'u' AS user_id, 6000.0D AS amount,
                  timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) AS event_time,
                  c AS merchant_country
           FROM VALUES (0, 0, 'US'), (1, 59, 'UK'), (2, 119, 'DE'), (3, 200, 'FR'), (4, 300, 'JP'), (5, 400, 'IN'),
                       (6, 86400, 'IN') v(i, s, c)"""
    )
    burst = {r["transaction_id"]: r["rule_burst_amount"] for r in burst_amount_rule(rows).collect()}
    assert burst == {"t0": False, "t1": True, "t2": False, "t3": False, "t4": False, "t5": False, "t6": False}
    spread = {r["transaction_id"]: (r["country_count_24h"], r["rule_country_spread"]) for r in country_spread_rule(rows).collect()}
    assert spread["t4"] == (5, False) and spread["t5"] == (6, True) and spread["t6"] == (5, False)
    geo = {r["transaction_id"]: r for r in geo_velocity(rows).collect()}
    assert geo["t0"]["previous_country"] is None and not geo["t0"]["country_changed"]
    assert geo["t1"]["country_changed"] and geo["t6"]["previous_country"] == "IN" and not geo["t6"]["country_changed"]
    assert geo["t6"]["hours_since_previous"] == pytest.approx((86400 - 400) / 3600)


def test_generator_is_repeatable_and_skewed(spark):
    first = synthetic_transactions(spark, 20_000, seed=1)
    again = synthetic_transactions(spark, 20_000, seed=1).repartition(3)
    assert first.exceptAll(again).count() == 0
    rows = first.toPandas()
    assert rows["transaction_id"].is_unique
    assert 0.015 < rows["is_injected"].mean() < 0.025
    injected = rows.loc[rows["is_injected"], "amount"]
    assert injected.between(5000, 50000).all()
    usual = rows[~rows["is_injected"]]
    assert np.log(usual["amount"].clip(lower=0.01)).mean() == pytest.approx(3.5, abs=0.05)
    assert (usual["merchant_country"] == "US").mean() == pytest.approx(0.865, abs=0.02)
    assert (rows["merchant_category"] == "grocery").mean() == pytest.approx(0.2, abs=0.02)
    assert rows["user_id"].str[5:].astype(int).between(1000, 9999).all()
