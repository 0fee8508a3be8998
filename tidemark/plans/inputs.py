"""The given tables read as telemetry.

``events``: key ``user_id``, one channel per event type holding ``value``. Values have
two decimals and are taken as decimals, so that sums do not depend on their order. The
table arrives in time order; one record in twenty is held back by a rule, which makes
``(arrival_ms, event_id)`` its arrival order.

``lineitem``: key ``l_suppkey``, ship date as event time, four numeric columns as channels.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.lateness import annotate_lateness, windows_changelog, windows_final
from tidemark.operators.windows import telemetry_windows
from tidemark.schema import Rule, WindowSpec, result_schema
from tidemark.session import scratch_dir

KEYS = ("user_id",)
ORDER = ("arrival_ms", "event_id")
EVENT_TYPES = ("error", "view", "click", "purchase", "signup")
CHANNELS = tuple(f"ch_{t}" for t in EVENT_TYPES)
HOUR_MS = 3_600_000
SPEC = WindowSpec(size_ms=6 * HOUR_MS, delay_ms=HOUR_MS // 2, lateness_ms=6 * HOUR_MS)
RULES = (
    Rule("error_burst", "ch_error", "max", ">", 90.0),
    Rule("view_drop", "ch_view", "min", "<", 5.0),
    Rule("click_drift", "ch_click", "max", ">", 60.0),
)
METRIC = "ch_error_max"
HOLD_STEP_MS = 600_000
HOLD_STEPS = 180
SLICES = 3
# Of so many records, one comes 40 days late and one 400.
OLD_EVERY = 200
OLD_MS = (40 * 24 * HOUR_MS, 400 * 24 * HOUR_MS)

# One record in so many has no event time.
MISSING_EVERY, MISSING_AT = 50, 11
# The telemetry as a source of three partitions: arrivals lag by partition, and the last one
# has long pauses. A batch takes each partition up to another arrival.
PARTITIONS = 3
PARTITION_LAG_MS = 3 * HOUR_MS
IDLE_MS = HOUR_MS // 3
CUT_MS = 5 * HOUR_MS

LINE_KEYS = ("l_suppkey",)
LINE_CHANNELS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_SPEC = WindowSpec(size_ms=30 * 24 * HOUR_MS, delay_ms=0, lateness_ms=0)
LINE_RULES = (
    Rule("bulk", "l_quantity", "min", ">", 45.0),
    Rule("untaxed", "l_tax", "max", "<", 0.01),
    Rule("discounted", "l_discount", "max", ">", 0.09),
)
DECIMAL = "decimal(18,2)"

SHAPE = {"keys": KEYS, "channels": CHANNELS, "spec": SPEC, "rules": RULES}
LINE_SHAPE = {
    "keys": LINE_KEYS,
    "channels": LINE_CHANNELS,
    "spec": LINE_SPEC,
    "rules": LINE_RULES,
}


@dataclass(frozen=True)
class Inputs:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def telemetry(self) -> DataFrame:
        ms = F.unix_millis(F.col("ts").cast("timestamp"))
        held = (F.lit(1) + (F.col("event_id") * 7919) % HOLD_STEPS) * HOLD_STEP_MS
        value = F.col("value").cast(DECIMAL)
        return self.table("events").select(
            "event_id",
            "user_id",
            ms.alias("event_ts_ms"),
            (ms + F.when(F.col("event_id") % 20 == 7, held).otherwise(0)).alias("arrival_ms"),
            *[F.when(F.col("event_type") == t, value).alias(f"ch_{t}") for t in EVENT_TYPES],
        )

    @cached_property
    def lines(self) -> DataFrame:
        return self.table("lineitem").select(
            "l_suppkey",
            F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("event_ts_ms"),
            *[F.col(c).cast(DECIMAL).alias(c) for c in LINE_CHANNELS],
        )

    @cached_property
    def annotated(self) -> DataFrame:
        return annotate_lateness(self.telemetry, SPEC, ORDER)

    @cached_property
    def windows(self) -> DataFrame:
        return telemetry_windows(self.telemetry, **SHAPE)

    @cached_property
    def final(self) -> DataFrame:
        return windows_final(self.annotated, **SHAPE)

    @cached_property
    def changelog(self) -> DataFrame:
        return windows_changelog(self.annotated, **SHAPE)

    @cached_property
    def schema(self) -> T.StructType:
        return result_schema(CHANNELS, [T.StructField("user_id", T.LongType(), False)])

    def scratch(self, name: str) -> str:
        return scratch_dir(self.spark, name)

    @cached_property
    def with_old_records(self) -> DataFrame:
        """The telemetry with some event times weeks or months behind their arrival."""
        nth = F.col("event_id") % OLD_EVERY
        behind = F.when(nth == 7, OLD_MS[0]).when(nth == OLD_EVERY // 2, OLD_MS[1]).otherwise(0)
        return self.telemetry.withColumn("event_ts_ms", F.col("event_ts_ms") - behind)

    @cached_property
    def with_missing_times(self) -> DataFrame:
        missing = F.col("event_id") % MISSING_EVERY == MISSING_AT
        return self.telemetry.withColumn("event_ts_ms", F.when(~missing, F.col("event_ts_ms")))

    @cached_property
    def partitioned(self) -> DataFrame:
        """The telemetry with the partition that each record came by."""
        part = F.when(F.col("event_id") % 7 == 0, PARTITIONS - 1).otherwise(F.col("event_id") % 2)
        later = F.col("arrival_ms") + F.col("part") * PARTITION_LAG_MS
        return self.telemetry.withColumn("part", part.cast("long")).withColumn("arrival_ms", later)

    def arrive_by_partition(self, folder: str):
        """Write ``partitioned`` below ``folder``, cutting each partition somewhere else."""
        bounds = self.partitioned.agg(F.min("arrival_ms"), F.max("arrival_ms")).first()
        step = (bounds[1] - bounds[0]) // SLICES + 1
        at = F.col("arrival_ms") - F.lit(bounds[0]) + (F.col("part") - 1) * CUT_MS
        slice_ = F.least(F.greatest(F.floor(at / step), F.lit(0)), F.lit(SLICES - 1))
        for i in range(SLICES):
            self.partitioned.where(slice_ == i).write.mode("append").parquet(folder)
            yield i

    def arrive_in_slices(self, folder: str, rows: DataFrame | None = None):
        """Write ``rows`` below ``folder`` in order of arrival, one slice per step."""
        rows = self.telemetry if rows is None else rows
        bounds = self.telemetry.agg(F.min("arrival_ms"), F.max("arrival_ms")).first()
        step = (bounds[1] - bounds[0]) // SLICES + 1
        for i in range(SLICES):
            low = bounds[0] + i * step
            arrived = (F.col("arrival_ms") >= low) & (F.col("arrival_ms") < low + step)
            rows.where(arrived).write.mode("append").parquet(folder)
            yield i
