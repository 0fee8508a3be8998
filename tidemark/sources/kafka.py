"""Broker records in and out. The connector package is the deployment's to provide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.config import Broker
from tidemark.functions import nan_to_null


def source_options(
    servers: str | None = None, topic: str | None = None, group: str | None = None
) -> dict[str, str]:
    broker = Broker.configured()
    options = {
        "kafka.bootstrap.servers": servers or broker.servers,
        "subscribe": topic or broker.topic,
        "startingOffsets": "earliest",
    }
    if group:
        options["groupIdPrefix"] = group
    return options


def read_kafka(
    spark: SparkSession,
    servers: str | None = None,
    topic: str | None = None,
    group: str | None = None,
) -> DataFrame:
    return (
        spark.readStream.format("kafka").options(**source_options(servers, topic, group)).load()
    )


def decode_json(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    *,
    on_error: str = "fail",
    keep: Sequence[str] = (),
    malformed: str | None = None,
) -> DataFrame:
    """Parse each message once into typed columns, with NaN readings as missing.

    ``keep`` names columns of ``df`` that stay beside them, such as the broker's partition,
    offset and timestamp, from which an order of arrival and a fence can be made.
    ``on_error='null'`` gives a row of nulls for a malformed message instead of failing;
    ``malformed`` then names a column that holds the raw message of such rows, else null,
    by which they can be split off to the dead letters.
    """
    mode = {"fail": "FAILFAST", "null": "PERMISSIVE"}[on_error]
    text = F.col(value).cast("string")
    target = schema
    if malformed is not None:
        target = T.StructType([*schema.fields, T.StructField(malformed, T.StringType())])
    options = {"mode": mode} | ({"columnNameOfCorruptRecord": malformed} if malformed else {})
    parsed = df.select(*keep, F.from_json(text, target, options).alias("_r")).select(*keep, "_r.*")
    floats = [f.name for f in schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return parsed.withColumns({c: nan_to_null(F.col(c)) for c in floats}) if floats else parsed


def kafka_payload(df: DataFrame, key: str = "sat_id") -> DataFrame:
    """Message key and JSON value per record."""
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value")
    )


# Producer settings for acknowledged, duplicate-free sends.
PRODUCER_OPTIONS: Mapping[str, str] = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.linger.ms": "20",
}


def write_kafka(
    payload: DataFrame, checkpoint: str, servers: str | None = None, topic: str | None = None
) -> DataStreamWriter:
    """A configured writer for a streaming ``payload``; the caller sets a trigger and starts it."""
    broker = Broker.configured(payload.sparkSession)
    return (
        payload.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers or broker.servers)
        .option("topic", topic or broker.topic)
        .options(**PRODUCER_OPTIONS)
        .option("checkpointLocation", checkpoint)
    )
