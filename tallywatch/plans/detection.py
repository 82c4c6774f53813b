"""Stored transactions to scored windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.config import DetectionConfig, WindowConfig
from tallywatch.functions.times import interval
from tallywatch.operators.scoring import as_score_table, score_windows
from tallywatch.operators.window_features import window_features


def valid_amounts(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.col("transaction_id").isNotNull() & (F.col("amount") > 0))


def scored_windows(
    transactions: DataFrame, cfg: DetectionConfig = DetectionConfig(), processed_at: Column | None = None
) -> DataFrame:
    """The score table for stored transactions."""
    windows = window_features(valid_amounts(transactions), cfg.window)
    return as_score_table(score_windows(windows, cfg.score, processed_at))


def last_window_end(transactions: DataFrame, cfg: WindowConfig = WindowConfig()) -> Column:
    """End of the last window that holds a valid transaction, as a scalar."""
    last = valid_amounts(transactions).agg(F.max("event_time").alias("_last"))
    start = F.window("_last", cfg.slide)["start"]
    return last.select((start + interval(cfg.length)).alias("as_of")).scalar()
