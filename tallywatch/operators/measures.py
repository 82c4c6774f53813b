"""Reporting measures over flagged transactions, scores and views."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.labels import TIER_NAMES
from tallywatch.functions.moments import count_where, safe_percentage

# Score limits of the alert filter and of the rate measure.
HIGH_SCORE_ABOVE = 0.8
RATE_SCORE_ABOVE = 0.5


def merchant_fraud_rate(transactions: DataFrame, flag: Column) -> DataFrame:
    """Transactions, flagged transactions and their percentage per merchant."""
    return (
        transactions.groupBy("merchant_id")
        .agg(F.count(F.lit(1)).alias("txn_count"), count_where(flag).alias("flagged_count"))
        .withColumn("fraud_rate_pct", safe_percentage(F.col("flagged_count"), F.col("txn_count")))
    )


def distribution(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def fraud_rate_measure(alerts: DataFrame, scores: DataFrame) -> DataFrame:
    """Alerts scoring above 0.5 per hundred score rows; 0 without score rows."""
    high = alerts.filter(F.col("fraud_score") > RATE_SCORE_ABOVE).select(F.lit(1).alias("_high"))
    both = high.withColumn("_row", F.lit(0)).unionByName(
        scores.select(F.lit(0).alias("_high"), F.lit(1).alias("_row"))
    )
    totals = both.agg(F.sum("_high").alias("_high"), F.sum("_row").alias("_rows"))
    rate = F.coalesce(F.try_divide(F.col("_high").cast("double"), F.col("_rows").cast("double")), F.lit(0.0))
    return totals.select((rate * 100).alias("fraud_rate_pct"))


def average_latency(kpi: DataFrame) -> DataFrame:
    return kpi.agg(F.avg("avg_detection_latency_ms").alias("avg_latency_ms"))


def at_risk_usd(profile: DataFrame) -> DataFrame:
    """24-hour amount of users in the highest tier."""
    return profile.filter(F.col("risk_tier") == "CRITICAL").agg(
        F.sum("total_amount_24h").alias("at_risk_usd")
    )


def high_score_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.filter(F.col("fraud_score") > HIGH_SCORE_ABOVE)


def with_tiers(profile: DataFrame, tiers: Iterable[str] = TIER_NAMES) -> DataFrame:
    return profile.filter(F.col("risk_tier").isin(*tiers))


def volume_against_flags(profile: DataFrame) -> DataFrame:
    return profile.select("user_id", "total_amount_24h", "fraud_flags_count")


def kpi_cards(kpi: DataFrame) -> DataFrame:
    """The five cards; ``kpi`` is a KPI row with its fraud rate."""
    return kpi.select("fraud_alerts_1h", "at_risk_usd_1h", "avg_detection_latency_ms", "critical_users", "fraud_rate_pct")


def fraud_trend(summary: DataFrame) -> DataFrame:
    return summary.select("minute_bucket", "fraud_count", "fraud_rate_pct").orderBy("minute_bucket")


def top_risky_users(profile: DataFrame, k: int) -> DataFrame:
    """The k users with the highest peak score, ranked; ties go by user.

    The rank is taken over the k rows that remain after the top-k step.
    """
    order = [F.desc("peak_fraud_score"), F.asc("user_id")]
    top = profile.select("user_id", "risk_tier", "peak_fraud_score").orderBy(*order).limit(k)
    return top.withColumn("risk_rank", F.row_number().over(Window.orderBy(*order)))


def detection_metrics(rows: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """Confusion counts with precision, recall and false-positive rate."""
    counts = rows.agg(
        count_where(predicted & actual).alias("true_positives"),
        count_where(predicted & ~actual).alias("false_positives"),
        count_where(~predicted & actual).alias("false_negatives"),
        count_where(~predicted & ~actual).alias("true_negatives"),
    )
    tp, fp, fn, tn = (F.col(c) for c in counts.columns)
    return counts.withColumns(
        {
            "precision": F.try_divide(tp.cast("double"), tp + fp),
            "recall": F.try_divide(tp.cast("double"), tp + fn),
            "false_positive_rate": F.try_divide(fp.cast("double"), fp + tn),
        }
    )
