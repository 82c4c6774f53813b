"""Table layouts and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# The transaction record, in wire order.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("merchant_country", T.StringType()),
        T.StructField("card_present", T.BooleanType()),
        T.StructField("card_type", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("device_fingerprint", T.StringType()),
        T.StructField("is_high_risk_merchant", T.BooleanType()),
    ]
)

# The score table, in its declared column order.
SCORE_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("txn_count_1h", T.LongType()),
        T.StructField("total_amount_1h", T.DoubleType()),
        T.StructField("avg_amount_1h", T.DoubleType()),
        T.StructField("stddev_amount_1h", T.DoubleType()),
        T.StructField("max_amount_1h", T.DoubleType()),
        T.StructField("country_count_1h", T.LongType()),
        T.StructField("zscore_amount", T.DoubleType()),
        T.StructField("zscore_fraud_flag", T.BooleanType()),
        T.StructField("rule_high_velocity", T.BooleanType()),
        T.StructField("rule_country_velocity", T.BooleanType()),
        T.StructField("rule_large_amount", T.BooleanType()),
        T.StructField("is_fraud_suspected", T.BooleanType()),
        T.StructField("fraud_score", T.DoubleType()),
        T.StructField("processed_at", T.TimestampNTZType()),
    ]
)

# The model's input features, in matrix order.
MODEL_FEATURES = (
    "amount",
    "txn_count_1h",
    "total_amount_1h",
    "avg_amount_1h",
    "stddev_amount_1h",
    "max_amount_1h",
    "country_count_1h",
    "zscore_amount",
    "hour_of_day",
    "is_weekend",
    "is_high_risk_merchant_int",
    "is_card_not_present",
)

# Domains of the transaction fields, with the category weights
# used by the generator (same order as the categories).
MERCHANT_CATEGORIES = (
    "grocery",
    "electronics",
    "restaurant",
    "gas_station",
    "online_retail",
    "travel",
    "healthcare",
    "entertainment",
    "luxury_goods",
    "crypto_exchange",
)
MERCHANT_CATEGORY_WEIGHTS = (20, 10, 15, 8, 18, 5, 7, 9, 3, 5)
COUNTRIES = ("US", "UK", "CA", "DE", "FR", "JP", "AU", "BR", "IN", "SG")
HIGH_RISK_CATEGORIES = ("crypto_exchange", "luxury_goods")
CARD_TYPES = ("credit", "debit")
CHANNELS = ("online", "pos", "atm", "contactless")
