"""Window-level flags and the weighted score."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.config import ScoreConfig
from tallywatch.schema import SCORE_SCHEMA


def zscore_flags(windows: DataFrame, cfg: ScoreConfig = ScoreConfig()) -> DataFrame:
    """How far the largest amount lies above the window mean, and its flag."""
    spread = F.col("stddev_amount_1h")
    z = F.when(
        spread > 0, (F.col("max_amount_1h") - F.col("avg_amount_1h")) / spread
    ).otherwise(F.lit(0.0))
    return windows.withColumn("zscore_amount", z).withColumn(
        "zscore_fraud_flag", F.col("zscore_amount") > cfg.zscore_above
    )


def rule_flags(windows: DataFrame, cfg: ScoreConfig = ScoreConfig()) -> DataFrame:
    return windows.withColumns(
        {
            "rule_high_velocity": F.col("txn_count_1h") > cfg.txn_count_above,
            "rule_country_velocity": F.col("country_count_1h") > cfg.country_count_above,
            "rule_large_amount": F.col("max_amount_1h") > cfg.amount_above,
        }
    )


def fraud_score(
    flagged: DataFrame, cfg: ScoreConfig = ScoreConfig(), processed_at: Column | None = None
) -> DataFrame:
    """Combined flag, score and processing time.

    The weights are added in double precision in a fixed order, which decides
    on which side of a tier limit a combination falls.
    """
    weighted = (
        ("zscore_fraud_flag", cfg.weight_zscore),
        ("rule_high_velocity", cfg.weight_velocity),
        ("rule_country_velocity", cfg.weight_country),
        ("rule_large_amount", cfg.weight_large),
    )
    points = [F.col(name).cast("int") * F.lit(weight) for name, weight in weighted]
    return flagged.withColumns(
        {
            "is_fraud_suspected": reduce(or_, [F.col(name) for name, _ in weighted]),
            "fraud_score": reduce(lambda a, b: a + b, points),
            "processed_at": F.current_timestamp() if processed_at is None else processed_at,
        }
    )


def score_windows(
    windows: DataFrame, cfg: ScoreConfig = ScoreConfig(), processed_at: Column | None = None
) -> DataFrame:
    return fraud_score(rule_flags(zscore_flags(windows, cfg), cfg), cfg, processed_at)


def as_score_table(scored: DataFrame) -> DataFrame:
    """The score table's columns, matched by name and cast to its types."""
    return scored.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCORE_SCHEMA.fields]
    )


def emit_lag_ms(scored: DataFrame) -> DataFrame:
    """Milliseconds from the end of a window to its processing time."""
    lag = F.unix_millis(F.col("processed_at").cast("timestamp")) - F.unix_millis(
        F.col("window_end").cast("timestamp")
    )
    return scored.withColumn("emit_lag_ms", lag)
