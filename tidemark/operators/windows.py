"""Keyed tumbling-window aggregation and the projection to window results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import classify, is_anomaly, result_key, window_start
from tidemark.schema import CHANNELS, RULES, STATS, Rule, WindowSpec

KEYS = ("sat_id",)
TIME = "event_ts_ms"
START = "window_start_ms"


def channel_partials(
    schema: T.StructType, channels: Sequence[str], only: Column | None = None
) -> list[Column]:
    """Mergeable per-channel aggregates; ``only`` restricts the rows that count.

    A NaN reading is a missing one. Only floating columns of ``schema`` can hold it.
    """

    out = []
    for c in channels:
        picked = _picked(schema, c, only)
        out += [
            F.sum(picked).alias(f"{c}_sum"),
            F.count(picked).alias(f"{c}_cnt"),
            F.min(picked).alias(f"{c}_min"),
            F.max(picked).alias(f"{c}_max"),
        ]
    return out


def record_partials(schema: T.StructType, channels: Sequence[str]) -> list[Column]:
    """What :func:`channel_partials` are of a record alone."""
    out = []
    for c in channels:
        picked = _picked(schema, c)
        counted = picked.isNotNull().cast("long")
        out += [picked.alias(f"{c}_sum"), counted.alias(f"{c}_cnt"), picked.alias(f"{c}_min"), picked.alias(f"{c}_max")]
    return out


def _picked(schema: T.StructType, c: str, only: Column | None = None) -> Column:
    there = only
    if isinstance(schema[c].dataType, (T.FloatType, T.DoubleType)):
        there = ~F.isnan(c) if only is None else only & ~F.isnan(c)
    return F.col(c) if there is None else F.when(there, F.col(c))


def partial_kinds(channels: Sequence[str]) -> dict[str, str]:
    """How each column of :func:`channel_partials` merges with another of its kind."""
    kinds = {}
    for c in channels:
        kinds.update(
            {f"{c}_sum": "sum", f"{c}_cnt": "sum", f"{c}_min": "min", f"{c}_max": "max"}
        )
    return kinds


def to_results(
    merged: DataFrame,
    *,
    keys: Sequence[str],
    channels: Sequence[str],
    spec: WindowSpec,
    rules: Sequence[Rule],
    count: Column,
    late: Column,
    revision: Column,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Window results in table column order from rows holding channel partials."""
    stats = {}
    for c in channels:
        cnt = F.col(f"{c}_cnt")
        stats[f"{c}_avg"] = F.when(cnt > 0, F.col(f"{c}_sum").cast("double") / cnt)
        stats[f"{c}_min"] = F.col(f"{c}_min").cast("double")
        stats[f"{c}_max"] = F.col(f"{c}_max").cast("double")
    label = F.col("anomaly_type")
    return (
        merged.withColumns(stats)
        .withColumn("anomaly_type", classify(rules))
        .select(
            *keys,
            START,
            (F.col(START) + spec.size_ms).alias("window_end_ms"),
            count.cast("int").alias("sample_count"),
            late.cast("int").alias("late_count"),
            label,
            is_anomaly(label).alias("is_anomaly"),
            revision.cast("int").alias("revision"),
            result_key(keys).alias("result_key"),
            *[f"{c}_{s}" for c in channels for s in STATS],
            *extra,
        )
    )


def telemetry_windows(
    df: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    channels: Sequence[str] = CHANNELS,
    spec: WindowSpec = WindowSpec(),
    rules: Sequence[Rule] = RULES,
    time: str = TIME,
) -> DataFrame:
    """One row per key and window, every record with a time counted (no lateness applied).

    The only exchange carries partial aggregates, at most one row per task and
    window, so a hot key or a hot window costs no more than any other.
    """
    merged = (
        df.where(F.col(time).isNotNull())
        .withColumn(START, window_start(F.col(time), spec.size_ms))
        .groupBy(*keys, START)
        .agg(F.count(F.lit(1)).alias("_n"), *channel_partials(df.schema, channels))
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
