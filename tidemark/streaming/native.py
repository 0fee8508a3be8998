"""Built-in streaming windows, for uses that need neither revisions nor dead letters.

The watermark moves once per micro-batch and waits for the delay plus the allowed
lateness. In update mode a window is emitted whenever a batch changed it, in append
mode once, when no update can come any more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import event_time
from tidemark.operators.windows import KEYS, START, TIME, channel_partials, to_results
from tidemark.schema import CHANNELS, RULES, Rule, WindowSpec

EVENT_TIME = "event_ts"


def with_event_time(df: DataFrame, wait_ms: int, time: str = TIME) -> DataFrame:
    """Derive the event timestamp and bound its disorder by ``wait_ms``."""
    return df.withColumn(EVENT_TIME, event_time(F.col(time))).withWatermark(
        EVENT_TIME, f"{wait_ms} milliseconds"
    )


def native_windows(
    df: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    channels: Sequence[str] = CHANNELS,
    spec: WindowSpec = WindowSpec(),
    rules: Sequence[Rule] = RULES,
    time: str = TIME,
) -> DataFrame:
    """Streaming results of :func:`telemetry_windows`; the writer's output mode decides
    when they are emitted."""
    merged = (
        with_event_time(df, spec.delay_ms + spec.lateness_ms, time)
        .groupBy(*keys, F.window(EVENT_TIME, f"{spec.size_ms} milliseconds").alias("_w"))
        .agg(F.count(F.lit(1)).alias("_n"), *channel_partials(df.schema, channels))
        .withColumn(START, F.unix_millis("_w.start"))
    )
    zero = F.lit(0)
    return to_results(
        merged,
        keys=keys,
        channels=channels,
        spec=spec,
        rules=rules,
        count=F.col("_n"),
        late=zero,
        revision=zero,
    )


def drop_redelivered_stream(
    df: DataFrame, wait_ms: int, record_id: str = "record_id", time: str = TIME
) -> DataFrame:
    """Drop repeats of a record id that arrive within ``wait_ms`` of event time."""
    return with_event_time(df, wait_ms, time).dropDuplicatesWithinWatermark([record_id])
