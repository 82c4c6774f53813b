"""The reporting views over the score table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.config import ViewConfig
from tallywatch.functions.labels import alert_type, is_critical, risk_tier
from tallywatch.functions.moments import count_where, safe_percentage, sum_where
from tallywatch.functions.times import epoch_millis, interval, recent
from tallywatch.sources.score_store import DATE_COLUMN


def recent_scores(scores: DataFrame, as_of: Column, lookback: str) -> DataFrame:
    """Score rows processed within ``lookback`` of ``as_of``.

    Where the store's date column is present its own predicate is added, so
    older partitions are not listed.
    """
    kept = scores.filter(recent(F.col("processed_at"), as_of, lookback))
    if DATE_COLUMN in scores.columns:
        kept = kept.filter(F.col(DATE_COLUMN) >= F.to_date(as_of - interval(lookback)))
    return kept


def fraud_summary_by_minute(scores: DataFrame) -> DataFrame:
    """Per minute of window start. ``total_users_flagged`` counts all windows."""
    suspected = F.col("is_fraud_suspected")
    return (
        scores.groupBy(F.date_trunc("minute", "window_start").cast("timestamp_ntz").alias("minute_bucket"))
        .agg(
            F.count(F.lit(1)).alias("total_users_flagged"),
            count_where(suspected).alias("fraud_count"),
            sum_where(suspected, F.col("total_amount_1h")).alias("fraud_amount_at_risk"),
            F.avg("fraud_score").alias("avg_fraud_score"),
            F.max("fraud_score").alias("max_fraud_score"),
            F.sum("txn_count_1h").alias("total_txn_volume"),
        )
        .withColumn("fraud_rate_pct", safe_percentage(F.col("fraud_count"), F.col("total_users_flagged")))
    )


def user_risk_profile(
    scores: DataFrame, as_of: Column | None = None, lookback: str = ViewConfig.profile_lookback
) -> DataFrame:
    """Per-user totals and risk tier over the lookback.

    Totals add up overlapping windows; pass ``non_overlapping`` windows for
    totals that count each transaction once.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    flag_counts = {
        "zscore_flags": "zscore_fraud_flag",
        "velocity_flags": "rule_high_velocity",
        "geo_flags": "rule_country_velocity",
        "large_txn_flags": "rule_large_amount",
    }
    return (
        recent_scores(scores, as_of, lookback)
        .groupBy("user_id")
        .agg(
            F.max("processed_at").alias("last_seen_at"),
            F.count(F.lit(1)).alias("total_windows"),
            F.sum("txn_count_1h").alias("total_txn_24h"),
            F.sum("total_amount_1h").alias("total_amount_24h"),
            F.avg("avg_amount_1h").alias("avg_txn_amount_24h"),
            F.max("max_amount_1h").alias("max_single_txn_24h"),
            F.max("country_count_1h").alias("max_country_velocity"),
            count_where(F.col("is_fraud_suspected")).alias("fraud_flags_count"),
            F.max("fraud_score").alias("peak_fraud_score"),
            F.avg("fraud_score").alias("avg_fraud_score"),
            risk_tier(F.max("fraud_score")).alias("risk_tier"),
            *[count_where(F.col(flag)).alias(name) for name, flag in flag_counts.items()],
        )
    )


def alert_rows(scores: DataFrame) -> DataFrame:
    """Suspected windows, typed and renamed."""
    return scores.filter("is_fraud_suspected").select(
        "user_id",
        "window_start",
        "fraud_score",
        alert_type().alias("alert_type"),
        F.col("max_amount_1h").alias("flagged_amount"),
        F.col("country_count_1h").alias("country_count"),
        F.col("txn_count_1h").alias("transaction_count"),
        F.col("processed_at").alias("alert_generated_at"),
    )


def fraud_alerts(
    scores: DataFrame,
    as_of: Column | None = None,
    lookback: str = ViewConfig.alert_lookback,
    ordered: bool = False,
) -> DataFrame:
    """Suspected windows of the lookback, typed and renamed."""
    as_of = F.current_timestamp() if as_of is None else as_of
    alerts = alert_rows(recent_scores(scores, as_of, lookback))
    return alerts.orderBy(F.desc("fraud_score"), "user_id", "window_start") if ordered else alerts


def dashboard_kpi(
    scores: DataFrame, as_of: Column | None = None, lookback: str = ViewConfig.kpi_lookback, with_rate: bool = False
) -> DataFrame:
    """One row of totals over the lookback, also when it holds no rows.

    Latency is measured from the start of the window. ``with_rate`` adds
    ``fraud_rate_pct``, suspected windows per hundred.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    suspected = F.col("is_fraud_suspected")
    latency = epoch_millis(F.col("processed_at")) - epoch_millis(F.col("window_start"))
    return (
        recent_scores(scores, as_of, lookback)
        .agg(
            F.count_distinct("user_id").alias("active_users_1h"),
            F.sum("txn_count_1h").alias("total_transactions_1h"),
            F.sum("total_amount_1h").alias("total_volume_usd_1h"),
            count_where(suspected).alias("fraud_alerts_1h"),
            sum_where(suspected, F.col("total_amount_1h")).alias("at_risk_usd_1h"),
            F.round(F.avg(latency), 0).alias("avg_detection_latency_ms"),
            F.count_distinct(F.when(is_critical(F.col("fraud_score")), F.col("user_id"))).alias(
                "critical_users"
            ),
            *([safe_percentage(count_where(suspected), F.count(F.lit(1))).alias("fraud_rate_pct")] if with_rate else []),
        )
        .select(as_of.alias("refreshed_at"), "*")
    )


def fraud_feed(alerts: DataFrame, profile: DataFrame, ordered: bool = False) -> DataFrame:
    """Alerts with the user's tier, mean score and amount where known."""
    feed = alerts.join(
        profile.select("user_id", "risk_tier", "avg_fraud_score", "total_amount_24h"), "user_id", "left"
    ).select(
        "user_id",
        "alert_type",
        "fraud_score",
        "flagged_amount",
        "country_count",
        "transaction_count",
        "alert_generated_at",
        "risk_tier",
        "avg_fraud_score",
        "total_amount_24h",
    )
    return feed.orderBy(F.desc("fraud_score"), "user_id", "alert_generated_at") if ordered else feed
