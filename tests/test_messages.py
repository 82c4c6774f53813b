from __future__ import annotations

import json
from datetime import datetime

from tallywatch.config import StreamConfig
from tallywatch.schema import TRANSACTION_SCHEMA
from tallywatch.sources.messages import (
    dead_letters,
    decode,
    encode,
    kafka_options,
    parse_transactions,
    valid_transactions,
    with_rejection,
)
from tallywatch.streaming.monitor import count_deliveries

GOOD = {
    "transaction_id": "t1",
    "user_id": "user_1",
    "timestamp": "2024-01-01T05:00:00.123456+00:00",
    "amount": 12.5,
    "currency": "USD",
    "merchant_id": "merchant_100",
    "merchant_category": "travel",
    "merchant_country": "US",
    "card_present": True,
    "card_type": "credit",
    "channel": "pos",
    "ip_address": "10.0.0.1",
    "device_fingerprint": "abc",
    "is_high_risk_merchant": False,
}


def but(**changes):
    return json.dumps({**GOOD, **changes})


BODIES = {
    "good": json.dumps(GOOD),
    "truncated": '{"transaction_id":"t',
    "brace": "{bad",
    "empty": "",
    "none": None,
    "no id": but(transaction_id=None),
    "zero": but(amount=0),
    "negative": but(amount=-1),
    "text amount": but(amount="abc"),
    "no amount": but(amount=None),
    "bad time": but(timestamp="junk"),
    "extra field": but(more=1),
}
REASONS = {
    "truncated": "malformed_json",
    "brace": "malformed_json",
    "empty": "malformed_json",
    "none": "malformed_json",
    "no id": "missing_transaction_id",
    "zero": "invalid_amount",
    "negative": "invalid_amount",
    "text amount": "invalid_amount",
    "no amount": "invalid_amount",
    "bad time": "invalid_timestamp",
}


def messages(spark):
    rows = [
        (name.encode(), None if body is None else body.encode(), datetime(2024, 1, 1)) for name, body in BODIES.items()
    ]
    return spark.createDataFrame(rows, "key binary, value binary, timestamp timestamp")


def test_nothing_is_lost_in_decoding(spark):
    assert decode(messages(spark)).count() == len(BODIES)


def test_rejection_reasons(spark):
    rejected = dead_letters(with_rejection(messages(spark))).collect()
    assert {bytes(r["key"]).decode(): r["error"] for r in rejected} == REASONS
    for row in rejected:
        body = BODIES[bytes(row["key"]).decode()]
        assert row["value"] == (None if body is None else body.encode())
        assert row["original_topic"] == "transactions"


def test_valid_and_rejected_are_disjoint(spark):
    tagged = with_rejection(messages(spark))
    assert valid_transactions(tagged).count() + dead_letters(tagged).count() == len(BODIES)


def test_parse_keeps_unreadable_times(spark):
    rows = parse_transactions(messages(spark)).select("timestamp", "event_time").collect()
    assert len(rows) == 3
    assert [r["event_time"] for r in rows if r["timestamp"] == "junk"] == [None]
    assert datetime(2024, 1, 1, 5, 0, 0, 123456) in [r["event_time"] for r in rows]


def test_offset_other_than_utc(spark):
    rows = [(b"k", but(timestamp="2024-01-01T05:00:00+02:00").encode(), datetime(2024, 1, 1))]
    data = spark.createDataFrame(rows, "key binary, value binary, timestamp timestamp")
    assert parse_transactions(data).first()["event_time"] == datetime(2024, 1, 1, 3)


def test_encode_then_decode(spark):
    row = spark.createDataFrame([tuple(GOOD.values())], TRANSACTION_SCHEMA)
    sent = encode(row)
    assert bytes(sent.first()["key"]) == b"user_1"
    assert json.loads(bytes(sent.first()["value"])) == GOOD
    back = decode(sent.selectExpr("*", "current_timestamp() AS timestamp"))
    assert back.select(*row.columns).first() == row.first()


def test_decoding_happens_once(spark):
    plan = with_rejection(messages(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_source_options():
    options = kafka_options("broker:9092", StreamConfig(max_offsets_per_trigger=7))
    assert options["subscribe"] == "transactions"
    assert options["startingOffsets"] == "latest"
    assert options["maxOffsetsPerTrigger"] == "7"
    assert options["failOnDataLoss"] == "false"


def test_delivery_counters(spark):
    from pyspark.sql import Observation

    seen = Observation("ingest")
    count_deliveries(with_rejection(messages(spark)), seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"messages_sent": 2, "messages_failed": 10}
