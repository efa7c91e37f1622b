import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from usagelens.functions.slot_ids import SLOT_NAMESPACE, slot_event_id
from usagelens.functions.wire import decode_events, rejected
from usagelens.schema import WIRE_SCHEMA
from usagelens.sources import kafka

EVENT = {
    "event_id": "e1", "timestamp": "2024-03-01T12:30:00.123456+02:00", "user_id": "u1",
    "user_tier": "pro", "endpoint": "/v1/chat", "model_variant": "m", "input_tokens": 5,
    "output_tokens": 7, "latency_ms": 12.5, "status_code": 200, "error_type": None,
    "sdk_version": "2.0.0", "region": "eu", "session_id": "s", "rate_limited": False,
    "will_churn": True, "churn_day": 40,
}


def decode(spark, *texts, bad="fail"):
    return decode_events(spark.createDataFrame([(t,) for t in texts], "value string"), bad=bad)


def test_decode_reads_offsets_and_numbers(spark):
    row = decode(spark, json.dumps(EVENT)).select(
        "*", F.unix_micros("timestamp").alias("us")).first()
    want = dt.datetime.fromisoformat(EVENT["timestamp"])
    assert row["us"] == round(want.timestamp() * 1_000_000)
    assert float(row["latency_ms"]) == 12.5 and row["error_type"] is None and row["churn_day"] == 40


def test_a_message_without_optional_keys(spark):
    short = {k: v for k, v in EVENT.items() if k not in ("will_churn", "churn_day")}
    row = decode(spark, json.dumps(short)).first()
    assert row["will_churn"] is None and row["churn_day"] is None


def test_encode_is_flat_json_with_all_keys(spark):
    sent = kafka.messages(decode(spark, json.dumps(EVENT)))
    assert sent.columns == ["value"]
    got = json.loads(sent.first()["value"])
    assert list(got) == WIRE_SCHEMA.names
    assert got["error_type"] is None and got["timestamp"] == "2024-03-01T10:30:00.123456+00:00"
    assert decode(spark, json.dumps(got)).collect() == decode(spark, json.dumps(EVENT)).collect()


def test_malformed_messages(spark):
    good, bad = json.dumps(EVENT), "{not json"
    with pytest.raises(Exception):
        decode(spark, good, bad).collect()
    assert decode(spark, good, bad, bad="drop").count() == 1
    assert {r["event_id"] for r in decode(spark, good, bad, bad="null").collect()} == {"e1", None}
    with pytest.raises(ValueError):
        decode(spark, good, bad="skip")


DAMAGED = {
    "malformed": {**EVENT, "input_tokens": "abc"},
    "no user_id": {k: v for k, v in EVENT.items() if k != "user_id"},
    "bad timestamp": {**EVENT, "timestamp": "soon"},
}


@pytest.mark.parametrize("reason", DAMAGED)
def test_each_kind_of_damage_in_each_mode(spark, reason):
    good, bad = json.dumps(EVENT), json.dumps(DAMAGED[reason])
    with pytest.raises(Exception, match=reason):
        decode(spark, good, bad).collect()
    assert decode(spark, good, bad, bad="drop").count() == 1
    nulls = [r for r in decode(spark, good, bad, bad="null").collect() if r["event_id"] is None]
    assert len(nulls) == 1 and not any(nulls[0])
    found = rejected(spark.createDataFrame([(good,), (bad,), (None,)], "value string")).collect()
    assert sorted((r["reason"], r["value"]) for r in found if r["value"]) == [(reason, bad)]
    assert [r["reason"] for r in found if r["value"] is None] == ["empty"]


def test_messages_as_the_connector_gives_them(spark):
    raw = spark.createDataFrame(
        [(None, bytearray(json.dumps(EVENT).encode()), "api_events", 2, 41, dt.datetime(2024, 3, 1))],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp")
    row = kafka.received(raw).first()
    assert (row["event_id"], row["partition"], row["offset"]) == ("e1", 2, 41)
    assert row["arrived_at"] == dt.datetime(2024, 3, 1)


def test_broker_list():
    options = kafka.kafka_options(" a:1, ,b:2 ", kafka__security__protocol="SASL_SSL")
    assert options == {"kafka.bootstrap.servers": "a:1,b:2", "kafka.security.protocol": "SASL_SSL"}
    with pytest.raises(ValueError):
        kafka.kafka_options(" , ")


def test_slot_ids_equal_uuid5(spark):
    start = dt.datetime(2024, 2, 28, 23, 50, tzinfo=dt.timezone.utc)
    minutes = [start + dt.timedelta(minutes=37 * i) for i in range(60)]
    df = spark.createDataFrame([(m,) for m in minutes], "slot timestamp")
    got = [r["id"] for r in df.select(slot_event_id("slot").alias("id")).collect()]
    assert got == [str(uuid.uuid5(SLOT_NAMESPACE, m.strftime("%Y-%m-%d %H:%M"))) for m in minutes]
