"""File sources: bounded replay as a stream, and scans of stored window results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def replay(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """A finite set of files as a stream; run it with ``trigger(availableNow=True)``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
