from tidemark.functions.columns import (
    classify,
    event_time,
    is_anomaly,
    json_encode,
    nan_to_null,
    null_to_zero,
    position,
    record_id,
    result_key,
    window_end,
    window_start,
)

__all__ = [
    "classify",
    "event_time",
    "is_anomaly",
    "json_encode",
    "nan_to_null",
    "null_to_zero",
    "position",
    "record_id",
    "result_key",
    "window_end",
    "window_start",
]
