from __future__ import annotations

import itertools
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallywatch.functions.labels import alert_type, risk_tier
from tallywatch.operators.scoring import as_score_table, emit_lag_ms, fraud_score, rule_flags, zscore_flags
from tallywatch.schema import SCORE_SCHEMA

FLAGS = ("zscore_fraud_flag", "rule_high_velocity", "rule_country_velocity", "rule_large_amount")
WEIGHTS = (0.4, 0.2, 0.25, 0.15)


def expected_score(flags):
    total = int(flags[0]) * WEIGHTS[0]
    for flag, weight in zip(flags[1:], WEIGHTS[1:]):
        total += int(flag) * weight
    return total


def expected_tier(score):
    return "CRITICAL" if score >= 0.8 else "HIGH" if score >= 0.5 else "MEDIUM" if score >= 0.25 else "LOW"


def expected_alert(z, velocity, country, large):
    if z and velocity and large:
        return "MULTI_SIGNAL_FRAUD"
    if z and country:
        return "GEO_ANOMALY_FRAUD"
    if velocity and large:
        return "VELOCITY_FRAUD"
    if z:
        return "STATISTICAL_ANOMALY"
    return "GEO_VELOCITY" if country else "RULE_BASED_FLAG"


def test_all_flag_combinations(spark):
    combinations = list(itertools.product([False, True], repeat=4))
    rows = fraud_score(spark.createDataFrame(combinations, list(FLAGS))).select(
        "*", risk_tier(F.col("fraud_score")).alias("tier"), alert_type().alias("alert")
    )
    got = {tuple(r[f] for f in FLAGS): r for r in rows.collect()}
    assert len(got) == 16
    for flags in combinations:
        row, score = got[flags], expected_score(flags)
        assert row["fraud_score"] == score
        assert row["is_fraud_suspected"] == any(flags) == (score > 0)
        assert row["tier"] == expected_tier(score)
        assert row["alert"] == expected_alert(*flags)
    assert got[(True, False, True, True)]["tier"] == "CRITICAL"
    assert got[(True, True, False, True)]["tier"] == "HIGH"


@pytest.mark.parametrize(
    "score, tier",
    [(0.8, "CRITICAL"), (0.79, "HIGH"), (0.5, "HIGH"), (0.49, "MEDIUM"), (0.25, "MEDIUM"), (0.24, "LOW"), (None, "LOW")],
)
def test_tier_limits(spark, score, tier):
    frame = spark.createDataFrame([(score,)], "s double")
    assert frame.select(risk_tier(F.col("s"))).first()[0] == tier


def test_zscore_needs_spread(spark):
    rows = spark.createDataFrame(
        [(10.0, 10.0, None), (10.0, 10.0, 0.0), (40.0, 10.0, 10.0), (41.0, 10.0, 10.0)],
        "max_amount_1h double, avg_amount_1h double, stddev_amount_1h double",
    )
    got = [(r["zscore_amount"], r["zscore_fraud_flag"]) for r in zscore_flags(rows).collect()]
    assert got == [(0.0, False), (0.0, False), (3.0, False), (3.1, True)]


def test_rule_limits_are_strict(spark):
    rows = spark.createDataFrame(
        [(20, 3, 5000.0), (21, 4, 5000.01)], "txn_count_1h long, country_count_1h long, max_amount_1h double"
    )
    got = [tuple(r)[-3:] for r in rule_flags(rows).collect()]
    assert got == [(False,) * 3, (True,) * 3]


def test_score_table_goes_by_name(spark):
    values = {f.name: F.lit(None).cast(f.dataType) for f in SCORE_SCHEMA.fields}
    shuffled = spark.range(1).select(*[values[n].alias(n) for n in sorted(values)])
    assert as_score_table(shuffled).schema.names == SCORE_SCHEMA.names


def test_emit_lag(spark):
    rows = spark.createDataFrame(
        [(datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 1, 10, 0, 5000))], "window_end timestamp, processed_at timestamp"
    )
    assert emit_lag_ms(rows).first()["emit_lag_ms"] == 600_005
