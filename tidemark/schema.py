"""The one channel list, rule list and table schema everything else derives from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

NOMINAL = "nominal"

# Telemetry channels, in column order.
CHANNELS: tuple[str, ...] = (
    "bus_voltage_v",
    "bus_current_a",
    "battery_soc_pct",
    "solar_array_w",
    "temp_battery_c",
    "temp_payload_c",
    "temp_radiator_c",
    "attitude_error_deg",
    "gyro_rate_dps",
    "snr_db",
    "downlink_mbps",
    "packet_loss_pct",
    "payload_power_w",
    "data_buffer_pct",
)

STATS: tuple[str, ...] = ("avg", "min", "max")


@dataclass(frozen=True)
class Rule:
    """A window is labelled ``label`` when ``{channel}_{stat} {op} value``."""

    label: str
    channel: str
    stat: str
    op: str
    value: float

    @property
    def column(self) -> str:
        return f"{self.channel}_{self.stat}"


# Labels and thresholds, highest priority first.
RULES: tuple[Rule, ...] = (
    Rule("thermal_runaway", "temp_battery_c", "max", ">", 30.0),
    Rule("dropout", "snr_db", "min", "<", 6.0),
    Rule("drift", "attitude_error_deg", "max", ">", 0.5),
)


@dataclass(frozen=True)
class WindowSpec:
    """Tumbling window width, watermark delay and allowed lateness, all in ms."""

    size_ms: int = 30_000
    delay_ms: int = 2_000
    lateness_ms: int = 10_000

    def __post_init__(self) -> None:
        if self.size_ms <= 0:
            raise ValueError("size_ms must be positive")
        if self.delay_ms < 0 or self.lateness_ms < 0:
            raise ValueError("delay_ms and lateness_ms must not be negative")


def record_schema(channels: Sequence[str] = CHANNELS) -> T.StructType:
    """Schema of one telemetry record as it arrives from a broker or a file."""
    fields = [
        T.StructField("sat_id", T.StringType(), False),
        T.StructField("event_ts_ms", T.LongType(), False),
        T.StructField("ingest_seq", T.LongType(), True),
        T.StructField("record_id", T.StringType(), True),
        T.StructField("anomaly_type", T.StringType(), True),
    ]
    fields += [T.StructField(c, T.DoubleType(), True) for c in channels]
    return T.StructType(fields)


def result_schema(
    channels: Sequence[str] = CHANNELS,
    keys: Sequence[T.StructField] | None = None,
) -> T.StructType:
    """Schema of one window result; nullability is enforced on write, not by files."""
    fields = list(keys or [T.StructField("sat_id", T.StringType(), False)])
    fields += [
        T.StructField("window_start_ms", T.LongType(), False),
        T.StructField("window_end_ms", T.LongType(), False),
        T.StructField("sample_count", T.IntegerType(), False),
        T.StructField("late_count", T.IntegerType(), False),
        T.StructField("anomaly_type", T.StringType(), False),
        T.StructField("is_anomaly", T.IntegerType(), False),
        T.StructField("revision", T.IntegerType(), False),
        T.StructField("result_key", T.StringType(), False),
    ]
    fields += [
        T.StructField(f"{c}_{s}", T.DoubleType(), True) for c in channels for s in STATS
    ]
    return T.StructType(fields)
