"""Read-side queries over window results: rankings, percentiles, dashboard panels."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import event_time, null_to_zero
from tidemark.operators.running import running
from tidemark.operators.windows import KEYS, START
from tidemark.session import settle

METRIC = "temp_battery_c_max"


def anomalous_only(results: DataFrame) -> DataFrame:
    return results.where(F.col("is_anomaly") == 1)


def for_key(results: DataFrame, **key: object) -> DataFrame:
    """Drilldown to one key; prunes partitions where the table is laid out by key."""
    for column, value in key.items():
        results = results.where(F.col(column) == F.lit(value))
    return results


def top_anomaly_per_key(
    results: DataFrame, keys: Sequence[str] = KEYS, metric: str = METRIC
) -> DataFrame:
    """Each key's anomalous window with the highest metric, the earliest on a tie.

    Filtering on ``row_number() = 1`` lets Spark keep one row per key and task before
    the exchange, so a key with very many windows does not meet in one task.
    """
    best = Window.partitionBy(*keys).orderBy(F.col(metric).desc_nulls_last(), START)
    return (
        anomalous_only(results)
        .withColumn("_rank", F.row_number().over(best))
        .where("_rank = 1")
        .drop("_rank")
    )


def top_anomalies(
    results: DataFrame, keys: Sequence[str] = KEYS, metric: str = METRIC, n: int = 20
) -> DataFrame:
    return (
        top_anomaly_per_key(results, keys, metric)
        .orderBy(F.col(metric).desc_nulls_last(), START, *keys)
        .limit(n)
    )


def max_per_key(
    results: DataFrame, keys: Sequence[str] = KEYS, metric: str = METRIC, out: str = "m"
) -> DataFrame:
    """Highest metric over each key's anomalous windows, a missing value as zero."""
    return (
        anomalous_only(results)
        .groupBy(*keys)
        .agg(F.max(null_to_zero(F.col(metric))).alias(out))
    )


def top_values(
    results: DataFrame, keys: Sequence[str] = KEYS, metric: str = METRIC, n: int = 20
) -> DataFrame:
    return max_per_key(results, keys, metric).orderBy(F.col("m").desc(), *keys).select("m").limit(n)


def percentiles(
    df: DataFrame, column: str, ps: Mapping[str, float], target: int | None = None
) -> DataFrame:
    """Exact percentiles, interpolated linearly at ``(n - 1) * p``; 0 without rows.

    The built-in ``percentile`` merges all distinct values into one buffer. Here values
    are counted, the counts are accumulated in value order, and the rows whose ranks
    are asked for are picked out, so no task holds more than its share.
    """
    value = F.col(column).cast("double")
    counted = settle(
        df.select(value.alias("_v"))
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .groupBy("_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    size = counted.agg(F.count(F.lit(1)).alias("d"), F.sum("_c").alias("n")).first()
    n = size["n"] or 0
    ranked = running(counted, [], "_v", {"_upto": ("sum", "_c")}, target=target, at_most=size["d"])

    def at(rank: int) -> Column:
        here = (F.col("_upto") > rank) & (F.col("_upto") - F.col("_c") <= rank)
        return F.max(F.when(here, F.col("_v")))

    out = []
    for name, p in ps.items():
        place = max(n - 1, 0) * p
        low = math.floor(place)
        high = min(low + 1, max(n - 1, 0))
        part = place - low
        # A rank that is met exactly takes nothing of its neighbour, which may be infinite.
        blended = at(low) * F.lit(1 - part) + at(high) * F.lit(part) if part else at(low)
        out.append(F.coalesce(blended, F.lit(0.0)).alias(name))
    return ranked.agg(*out)


def panel_totals(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("window_results"),
        F.coalesce(F.sum("is_anomaly"), F.lit(0)).alias("anomalous_windows"),
        F.coalesce(F.sum("late_count"), F.lit(0)).alias("late_records"),
    )


def panel_series(
    results: DataFrame, keys: Sequence[str] = KEYS, metric: str = METRIC
) -> DataFrame:
    return results.select(event_time(F.col(START)).alias("time"), metric, *keys)


def panel_detail(
    results: DataFrame,
    keys: Sequence[str] = KEYS,
    stats: Mapping[str, str] | None = None,
) -> DataFrame:
    """Detail table columns; ``stats`` maps a statistic column to its heading."""
    if stats is None:
        stats = {
            "snr_db_min": "snr_min",
            "temp_battery_c_max": "temp_max",
            "attitude_error_deg_max": "att_err_max",
        }
    return results.select(
        *keys,
        event_time(F.col(START)).alias("window_start"),
        F.col("sample_count").alias("samples"),
        F.col("late_count").alias("late"),
        F.col("anomaly_type").alias("anomaly"),
        *[F.col(c).alias(heading) for c, heading in stats.items()],
    )


def export_order(results: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return results.orderBy(*keys, START)


def fire_order(results: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return results.orderBy(START, *keys)
