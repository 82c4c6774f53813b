"""Per-transaction features over stored transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.times import epoch_micros, is_night, is_weekend, micros_of, weekday_from_monday
from tallywatch.operators.quantiles import grouped_quantiles
from tallywatch.operators.trailing import (
    block_index,
    row_positions,
    rows_in_earlier_blocks,
    trailing_stats,
)
from tallywatch.schema import MODEL_FEATURES

DAY = micros_of("1 day")
TRAILING_HOUR = {
    "count": "txn_count_1h",
    "sum": "total_amount_1h",
    "avg": "avg_amount_1h",
    "stddev": "stddev_amount_1h",
    "max": "max_amount_1h",
}

# Fixed values of the row-based z-score.
ZSCORE_ROWS = 100
ZSCORE_MIN_ROWS = 10
ZSCORE_EPSILON = 1e-9

# Fixed value of the quartile rule.
IQR_REACH = 1.5


def _event_micros():
    return epoch_micros(F.col("event_time"))


def time_features(transactions: DataFrame) -> DataFrame:
    at = F.col("event_time")
    return transactions.withColumns(
        {
            "hour_of_day": F.hour(at),
            "day_of_week": weekday_from_monday(at),
            "is_weekend": is_weekend(at),
            "is_night": is_night(at),
            "log_amount": F.log1p("amount"),
        }
    )


def flag_features(transactions: DataFrame) -> DataFrame:
    return transactions.withColumns(
        {
            "is_high_risk_merchant_int": F.col("is_high_risk_merchant").cast("int"),
            "is_card_not_present": (~F.col("card_present")).cast("int"),
        }
    )


def trailing_hour_features(transactions: DataFrame, place: tuple[str, int] | None = None) -> DataFrame:
    """Count, sum, mean, spread and maximum over the user's last hour.

    The hour is open on the left and includes the row's own time; a single
    transaction has spread 0. Rows without user have no values.
    """
    measured = trailing_stats(
        transactions, ["user_id"], _event_micros(), micros_of("1 hour"), "amount", TRAILING_HOUR, place=place
    )
    spread = F.coalesce("stddev_amount_1h", F.lit(0.0))
    return measured.withColumn("stddev_amount_1h", F.when(F.col("user_id").isNotNull(), spread))


def trailing_count(transactions: DataFrame, frame: str = "24 hours", out: str = "txn_count_24h") -> DataFrame:
    return trailing_stats(
        transactions,
        ["user_id"],
        _event_micros(),
        micros_of(frame),
        "amount",
        {"count": out},
        block=micros_of("1 hour"),
    )


def row_zscore(
    transactions: DataFrame, out: str = "zscore_amount", known: tuple[str, str] | None = None
) -> DataFrame:
    """Distance from the mean of the user's last 100 rows, in deviations.

    Null until ten rows are seen. Rows are first numbered per user, so the
    row frame is a trailing frame over that number.
    """
    numbered = row_positions(
        transactions, ["user_id"], _event_micros(), "transaction_id", "_row", block=DAY, known=known
    )
    measured = trailing_stats(
        numbered,
        ["user_id"],
        F.col("_row"),
        ZSCORE_ROWS,
        "amount",
        {"count": "_seen", "avg": "_mean", "stddev": "_spread"},
    )
    z = (F.col("amount") - F.col("_mean")) / (F.col("_spread") + ZSCORE_EPSILON)
    return measured.withColumn(out, F.when(F.col("_seen") >= ZSCORE_MIN_ROWS, z)).select(
        *transactions.columns, out
    )


def amount_bounds(transactions: DataFrame) -> DataFrame:
    """Per user, the amounts below and above which a row is an outlier."""
    quartiles = grouped_quantiles(transactions, ["user_id"], "amount", {"q1": 0.25, "q3": 0.75})
    reach = IQR_REACH * (F.col("q3") - F.col("q1"))
    return quartiles.select(
        "user_id", (F.col("q1") - reach).alias("_low"), (F.col("q3") + reach).alias("_high")
    )


def iqr_outliers(
    transactions: DataFrame, history: DataFrame | None = None, out: str = "iqr_outlier"
) -> DataFrame:
    """1 where the amount lies outside the user's quartile bounds, else 0.

    The bounds come from the whole history, so this is for stored data only.
    ``history`` may be a narrower reading of the same rows.
    """
    outside = (F.col("amount") < F.col("_low")) | (F.col("amount") > F.col("_high"))
    return (
        transactions.join(amount_bounds(transactions if history is None else history), "user_id", "left")
        .withColumn(out, F.coalesce(outside, F.lit(False)).cast("int"))
        .select(*transactions.columns, out)
    )


def daily_summary(transactions: DataFrame, out: str = "country_count_1h") -> DataFrame:
    """Per user and day: distinct countries, and the user's rows before."""
    per_day = (
        transactions.select("user_id", block_index(_event_micros(), DAY).alias("_day"), "merchant_country")
        .groupBy("user_id", "_day")
        .agg(F.count_distinct("merchant_country").alias(out), F.count(F.lit(1)).alias("_rows"))
    )
    return per_day.withColumn("_earlier", rows_in_earlier_blocks(per_day, ["user_id"], "_day", "_rows")).drop("_rows")


def daily_countries(transactions: DataFrame, out: str = "country_count_1h") -> DataFrame:
    """Distinct countries of the user on the row's calendar day.

    The output keeps its customary name although it covers a day.
    """
    placed = transactions.withColumn("_day", block_index(_event_micros(), DAY))
    return placed.join(daily_summary(transactions, out), ["user_id", "_day"], "left").select(*transactions.columns, out)


def behavioral_features(transactions: DataFrame) -> DataFrame:
    """The full per-transaction feature frame.

    One exchange on (user, day) serves the trailing hour, the daily countries
    and the row numbering; the row z-score and the user bounds take one more
    each. Daily and per-user summaries are built from the input itself.
    """
    placed = trailing_hour_features(transactions, place=("_day", DAY))
    with_days = placed.join(daily_summary(transactions), ["user_id", "_day"], "left")
    with_z = row_zscore(with_days, known=("_day", "_earlier")).drop("_day", "_earlier")
    with_bounds = iqr_outliers(with_z, history=transactions)
    return flag_features(time_features(with_bounds))


def feature_vector(features: DataFrame, out: str = "features") -> DataFrame:
    """The model's inputs as one array, missing values as 0."""
    values = [F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in MODEL_FEATURES]
    return features.withColumn(out, F.array(*values))


def merchant_frequency(transactions: DataFrame, out: str = "merchant_frequency") -> DataFrame:
    """How often the user has paid this merchant over the whole history."""
    counts = transactions.groupBy("user_id", "merchant_id").agg(F.count(F.lit(1)).alias(out))
    return transactions.join(counts, ["user_id", "merchant_id"], "left").select(*transactions.columns, out)
