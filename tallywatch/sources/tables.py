"""Adapters from stored tables to the transaction model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.functions.times import iso_text
from tallywatch.schema import CHANNELS, COUNTRIES, HIGH_RISK_CATEGORIES, MERCHANT_CATEGORIES


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def pick(values: tuple[str, ...], position: Column) -> Column:
    """The element of ``values`` at a zero-based position."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position + 1).cast("int"))


def transactions_from_events(events: DataFrame) -> DataFrame:
    """The 14 transaction fields and ``event_time`` from an event table."""
    k = F.get_json_object("props", "$.k").cast("int")
    eid, uid = F.col("event_id"), F.col("user_id")
    category = pick(MERCHANT_CATEGORIES, eid % 10)
    return events.select(
        F.concat(F.lit("txn_"), eid.cast("string")).alias("transaction_id"),
        F.concat(F.lit("user_"), uid.cast("string")).alias("user_id"),
        iso_text(F.col("ts")).alias("timestamp"),
        F.col("value").alias("amount"),
        F.lit("USD").alias("currency"),
        F.concat(F.lit("merchant_"), (100 + eid % 900).cast("string")).alias("merchant_id"),
        category.alias("merchant_category"),
        F.when(k < 85, "US").otherwise(pick(COUNTRIES, k % 10)).alias("merchant_country"),
        (eid % 2 == 0).alias("card_present"),
        F.when(eid % 3 == 0, "debit").otherwise("credit").alias("card_type"),
        pick(CHANNELS, eid % 4).alias("channel"),
        F.concat_ws(
            ".", F.lit("10.0"), (uid % 256).cast("string"), (eid % 256).cast("string")
        ).alias("ip_address"),
        F.substring(F.md5(uid.cast("string").cast("binary")), 1, 16).alias("device_fingerprint"),
        category.isin(*HIGH_RISK_CATEGORIES).alias("is_high_risk_merchant"),
        F.col("ts").alias("event_time"),
    )


def transactions_from_order_lines(
    lineitem: DataFrame, orders: DataFrame, supplier: DataFrame, nation: DataFrame
) -> DataFrame:
    """One transaction per order line: the buyer pays the supplier.

    Ship dates have day granularity, so many rows share an event time.
    """
    sellers = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("merchant_country")
    )
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(sellers, "l_suppkey")
        .select(
            F.concat_ws(
                "-",
                F.col("l_orderkey").cast("string"),
                F.col("l_linenumber").cast("string"),
                F.col("l_partkey").cast("string"),
            ).alias("transaction_id"),
            F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("user_id"),
            F.col("l_extendedprice").alias("amount"),
            F.concat(F.lit("merchant_"), F.col("l_suppkey").cast("string")).alias("merchant_id"),
            F.col("merchant_country"),
            F.col("l_shipdate").alias("event_time"),
        )
    )


def query_history_from_orders(orders: DataFrame) -> DataFrame:
    """A query log in the cost tracker's layout."""
    return orders.select(
        F.col("o_orderpriority").alias("user_name"),
        F.col("o_orderdate").alias("start_time"),
        (F.col("o_totalprice") / 1e6).alias("credits"),
        F.col("o_custkey").cast("double").alias("elapsed_ms"),
        (F.col("o_totalprice") * 1e6).alias("bytes_scanned"),
    )


def offsets_from_events(events: DataFrame) -> DataFrame:
    """Committed and latest offsets per partition of one consumer group."""
    part = F.col("user_id") % 8
    return (
        events.groupBy(part.alias("partition"))
        .agg(F.max("event_id").alias("high"))
        .select(
            F.lit("detector").alias("group"),
            F.lit("transactions").alias("topic"),
            F.col("partition").cast("int").alias("partition"),
            F.when(F.col("partition") == 0, F.lit(-1).cast("long"))
            .otherwise(F.col("high") - 10 * F.col("partition"))
            .alias("committed"),
            F.col("high"),
        )
    )
