"""Seeded synthetic transactions, one per input id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.functions.times import iso_text
from tallywatch.functions.uniforms import choice, normal, uniform, whole_number
from tallywatch.schema import (
    CARD_TYPES,
    CHANNELS,
    COUNTRIES,
    HIGH_RISK_CATEGORIES,
    MERCHANT_CATEGORIES,
    MERCHANT_CATEGORY_WEIGHTS,
)

# Fixed values of the generated distribution.
INJECTED_SHARE = 0.02
INJECTED_AMOUNT = (5000.0, 50000.0)
USUAL_AMOUNT_LOG = (3.5, 1.2)
HOME_SHARE = 0.85
USER_NUMBERS = (1000, 9999)
MERCHANT_NUMBERS = (100, 999)


def synthetic_from_ids(ids: DataFrame, identity: str, at: Column, seed: int = 42) -> DataFrame:
    """A transaction per row of ``ids``, with an ``is_injected`` label.

    About 2 in 100 get an unusually large amount and any country; the others
    have log-normal amounts and mostly the home country. Values depend only on
    the id and the seed, not on partitioning.
    """
    key = F.col(identity)
    u = [uniform(key, seed, draw) for draw in range(20)]
    injected = u[2] < INJECTED_SHARE
    low, high = INJECTED_AMOUNT
    mean, spread = USUAL_AMOUNT_LOG
    amount = F.when(injected, F.lit(low) + u[3] * (high - low)).otherwise(
        F.exp(F.lit(mean) + F.lit(spread) * normal(u[4], u[5]))
    )
    country = F.when(~injected & (u[6] < HOME_SHARE), COUNTRIES[0]).otherwise(choice(u[7], COUNTRIES))
    category = choice(u[1], MERCHANT_CATEGORIES, MERCHANT_CATEGORY_WEIGHTS)
    digest = F.md5(F.concat_ws(":", F.lit(f"id{seed}"), key.cast("string")).cast("binary"))
    address = [whole_number(u[12], 1, 255)] + [whole_number(u[i], 0, 255) for i in (13, 14, 15)]
    return ids.select(
        digest.alias("transaction_id"),
        F.concat(F.lit("user_"), whole_number(u[0], *USER_NUMBERS).cast("string")).alias("user_id"),
        iso_text(at).alias("timestamp"),
        F.round(amount, 2).alias("amount"),
        F.lit("USD").alias("currency"),
        F.concat(F.lit("merchant_"), whole_number(u[8], *MERCHANT_NUMBERS).cast("string")).alias("merchant_id"),
        category.alias("merchant_category"),
        country.alias("merchant_country"),
        (u[9] < 0.5).alias("card_present"),
        choice(u[10], CARD_TYPES).alias("card_type"),
        choice(u[11], CHANNELS).alias("channel"),
        F.concat_ws(".", *[part.cast("string") for part in address]).alias("ip_address"),
        F.substring(digest, 17, 16).alias("device_fingerprint"),
        category.isin(*HIGH_RISK_CATEGORIES).alias("is_high_risk_merchant"),
        at.alias("event_time"),
        injected.alias("is_injected"),
    )


def synthetic_transactions(
    spark: SparkSession, n: int, seed: int = 42, start: str = "2024-01-01", per_second: int = 500
) -> DataFrame:
    """``n`` transactions at a steady rate from ``start``."""
    at = F.timestamp_micros(
        F.unix_micros(F.lit(start).cast("timestamp")) + F.col("id") * int(1_000_000 / per_second)
    ).cast("timestamp_ntz")
    return synthetic_from_ids(spark.range(n), "id", at, seed)
