from __future__ import annotations

import json
import math

import pytest

from tests.telemetry import frame
from tidemark.schema import CHANNELS, record_schema
from tidemark.sources.kafka import decode_json, kafka_payload, source_options


def test_messages_decode_to_typed_records(spark):
    record = {"sat_id": "A", "event_ts_ms": 5, "ingest_seq": 1, **dict.fromkeys(CHANNELS, 1.5)}
    df = spark.createDataFrame([(json.dumps(record).encode(),)], "value binary")
    row = decode_json(df, record_schema()).first()
    assert (row.sat_id, row.event_ts_ms, row.snr_db, row.record_id) == ("A", 5, 1.5, None)


def test_nan_reading_is_missing(spark):
    df = spark.createDataFrame([('{"sat_id": "A", "snr_db": NaN}',)], "value string")
    row = decode_json(df, record_schema()).first()
    assert row.snr_db is None and not math.isnan(row.event_ts_ms or 0)


def test_malformed_message_fails_or_becomes_null(spark):
    df = spark.createDataFrame([("{broken",)], "value string")
    assert decode_json(df, record_schema(), on_error="null").first().sat_id is None
    with pytest.raises(Exception):
        decode_json(df, record_schema()).collect()


def test_decoding_keeps_the_position_in_the_topic(spark):
    df = spark.createDataFrame([("{broken", 3, 17), ('{"sat_id": "A"}', 3, 18)], "value string, partition int, offset long")
    out = decode_json(df, record_schema(), on_error="null", keep=["partition", "offset"], malformed="raw")
    assert [(r.partition, r.offset, r.sat_id, r.raw) for r in out.orderBy("offset").collect()] == [
        (3, 17, None, "{broken"),
        (3, 18, "A", None),
    ]


def test_payload_round_trip(spark):
    df = frame(spark, [("A", 1, {"snr_db": 2.5})])
    message = kafka_payload(df).first()
    assert message.key == "A" and json.loads(message.value)["snr_db"] == 2.5


def test_source_reads_the_topic_from_the_start(monkeypatch):
    monkeypatch.setenv("KAFKA_BOOTSTRAP", "broker:1")
    monkeypatch.setenv("TELEMETRY_TOPIC", "t")
    assert source_options(group="g") == {
        "kafka.bootstrap.servers": "broker:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "groupIdPrefix": "g",
    }
