"""Risk tiers and alert types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier names with their lowest score, highest tier first.
RISK_TIERS = (("CRITICAL", 0.8), ("HIGH", 0.5), ("MEDIUM", 0.25))
LOWEST_TIER = "LOW"
TIER_NAMES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")

# Alert types with the signals they need, first match wins.
ALERT_TYPES = (
    ("MULTI_SIGNAL_FRAUD", ("zscore_fraud_flag", "rule_high_velocity", "rule_large_amount")),
    ("GEO_ANOMALY_FRAUD", ("zscore_fraud_flag", "rule_country_velocity")),
    ("VELOCITY_FRAUD", ("rule_high_velocity", "rule_large_amount")),
    ("STATISTICAL_ANOMALY", ("zscore_fraud_flag",)),
    ("GEO_VELOCITY", ("rule_country_velocity",)),
)
OTHER_ALERT = "RULE_BASED_FLAG"


def risk_tier(score: Column) -> Column:
    label = F.lit(LOWEST_TIER)
    for name, lowest in reversed(RISK_TIERS):
        label = F.when(score >= lowest, name).otherwise(label)
    return label


def is_critical(score: Column) -> Column:
    return score >= dict(RISK_TIERS)["CRITICAL"]


def alert_type() -> Column:
    label = F.lit(OTHER_ALERT)
    for name, signals in reversed(ALERT_TYPES):
        matched = F.col(signals[0])
        for signal in signals[1:]:
            matched = matched & F.col(signal)
        label = F.when(matched, name).otherwise(label)
    return label
