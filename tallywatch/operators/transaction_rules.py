"""Rules over single transactions and their recent past."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.config import RuleConfig
from tallywatch.functions.times import epoch_micros, micros_of
from tallywatch.operators.trailing import previous_values, trailing_distinct, trailing_stats


def burst_amount_rule(transactions: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """The user's amounts within the frame add up to more than the limit."""
    measured = trailing_stats(
        transactions,
        ["user_id"],
        epoch_micros(F.col("event_time")),
        micros_of(cfg.burst_frame),
        "amount",
        {"sum": "burst_amount"},
    )
    return measured.withColumn("rule_burst_amount", F.col("burst_amount") > cfg.burst_amount_above)


def country_spread_rule(transactions: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """More distinct countries than allowed within the frame."""
    frame = micros_of(cfg.country_frame)
    hour = micros_of("1 hour")
    counted = trailing_distinct(
        transactions,
        ["user_id"],
        epoch_micros(F.col("event_time")),
        frame,
        "merchant_country",
        "country_count_24h",
        block=min(hour, frame),
    )
    return counted.withColumn("rule_country_spread", F.col("country_count_24h") > cfg.country_count_above)


def card_not_present_rule(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn(
        "rule_cnp_high_risk", ~F.col("card_present") & F.col("is_high_risk_merchant")
    )


def geo_velocity(transactions: DataFrame) -> DataFrame:
    """Whether the country changed since the user's previous transaction, and
    the hours in between."""
    previous = previous_values(
        transactions,
        ["user_id"],
        epoch_micros(F.col("event_time")),
        micros_of("1 day"),
        "transaction_id",
        {"merchant_country": "previous_country", "event_time": "_previous_time"},
    )
    gap = epoch_micros(F.col("event_time")) - epoch_micros(F.col("_previous_time"))
    return previous.withColumns(
        {
            "country_changed": F.coalesce(
                F.col("merchant_country") != F.col("previous_country"), F.lit(False)
            ),
            "hours_since_previous": gap / F.lit(float(micros_of("1 hour"))),
        }
    ).drop("_previous_time")


def historical_zscore(transactions: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """Distance from the user's mean over all history, in deviations."""
    stats = transactions.groupBy("user_id").agg(
        F.avg("amount").alias("_mean"), F.stddev_samp("amount").alias("_spread")
    )
    z = F.when(F.col("_spread") > 0, (F.col("amount") - F.col("_mean")) / F.col("_spread")).otherwise(0.0)
    return (
        transactions.join(stats, "user_id", "left")
        .withColumn("historical_zscore", z)
        .withColumn("rule_historical_zscore", F.abs("historical_zscore") > cfg.historical_zscore_above)
        .select(*transactions.columns, "historical_zscore", "rule_historical_zscore")
    )
