"""Where the broker is: from Spark's configuration, else from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Spark setting, environment variable and default of each field.
_SOURCES = {
    "servers": ("tidemark.kafka.bootstrap", "KAFKA_BOOTSTRAP", "localhost:9092"),
    "topic": ("tidemark.kafka.topic", "TELEMETRY_TOPIC", "telemetry"),
}


@dataclass(frozen=True)
class Broker:
    servers: str
    topic: str

    @classmethod
    def configured(cls, spark: SparkSession | None = None) -> Broker:
        """The settings of ``spark``, or of the active session if there is one."""
        spark = spark or SparkSession.getActiveSession()

        def found(conf: str, variable: str, default: str) -> str:
            return (spark and spark.conf.get(conf, None)) or os.environ.get(variable, default)

        return cls(**{field: found(*names) for field, names in _SOURCES.items()})
