"""Message source, JSON decoding and encoding, and dead-letter rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.config import StreamConfig
from tallywatch.functions.times import parse_event_time
from tallywatch.schema import TRANSACTION_SCHEMA

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def kafka_options(servers: str, cfg: StreamConfig = StreamConfig()) -> dict[str, str]:
    """Reader options: newest offsets first, bounded intake, data loss tolerated."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": cfg.topic,
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": str(cfg.max_offsets_per_trigger),
        "failOnDataLoss": "false",
    }


def read_messages(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    schema: T.StructType | None = None,
    path: str | None = None,
) -> DataFrame:
    """A message stream from Kafka, or from files in the same layout."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        reader = reader.schema(schema or MESSAGE_SCHEMA)
    return reader.load(path) if path else reader.load()


def decode(messages: DataFrame) -> DataFrame:
    """All messages with their decoded fields and event time, none dropped.

    ``inline`` keeps the decoding in one place: filters and projections on the
    fields stay above it instead of each decoding the text again.
    """
    body = F.from_json(F.col("value").cast("string"), TRANSACTION_SCHEMA)
    return messages.select(
        "key",
        "value",
        F.col("timestamp").alias("kafka_timestamp"),
        F.inline(F.array(body)),
    ).withColumn("event_time", parse_event_time(F.col("timestamp")))


def parse_transactions(messages: DataFrame) -> DataFrame:
    """Decoded transactions that have an id and a positive amount."""
    return (
        decode(messages)
        .drop("key", "value")
        .filter(F.col("transaction_id").isNotNull())
        .filter(F.col("amount") > 0)
    )


def rejection_reason() -> Column:
    """Why a decoded message cannot be scored; null when it can."""
    nothing_read = F.coalesce(
        *[F.col(f.name).cast("string") for f in TRANSACTION_SCHEMA.fields]
    ).isNull()
    return (
        F.when(nothing_read, "malformed_json")
        .when(F.col("transaction_id").isNull(), "missing_transaction_id")
        .when(F.col("amount").isNull() | ~(F.col("amount") > 0), "invalid_amount")
        .when(F.col("event_time").isNull(), "invalid_timestamp")
    )


def with_rejection(messages: DataFrame) -> DataFrame:
    """Decoded messages tagged with ``error``; null marks a valid one."""
    return decode(messages).withColumn("error", rejection_reason())


def valid_transactions(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("error").isNull()).drop("key", "value", "error")


def dead_letters(tagged: DataFrame, topic: str = StreamConfig().topic) -> DataFrame:
    """Rejected messages, bytes unchanged, with the reason and the topic."""
    return tagged.filter(F.col("error").isNotNull()).select(
        "key", "value", "error", F.lit(topic).alias("original_topic")
    )


def encode(transactions: DataFrame) -> DataFrame:
    """Transactions as messages: the user keys a JSON body."""
    body = F.struct(*[F.col(f.name) for f in TRANSACTION_SCHEMA.fields])
    return transactions.select(
        F.col("user_id").cast("binary").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).cast("binary").alias("value"),
    )
