"""Small telemetry fixtures, and what should come out, worked out by definition."""

from __future__ import annotations

import random

from pyspark.sql import types as T

from tidemark.schema import CHANNELS, WindowSpec

SHIFT = 1_767_225_600_000  # 2026-01-01: streams need event times well after 1970

SCHEMA = T.StructType(
    [
        T.StructField("sat_id", T.StringType(), False),
        T.StructField("event_ts_ms", T.LongType(), False),
        T.StructField("ingest_seq", T.LongType(), False),
        *[T.StructField(c, T.DoubleType()) for c in CHANNELS],
    ]
)


def frame(spark, records, shift: int = 0):
    """``records``: (key, ms) or (key, ms, {channel: value}) in arrival order."""
    rows = []
    for seq, (key, ms, *more) in enumerate(records):
        values = {**dict.fromkeys(CHANNELS, 0.0), **(more[0] if more else {})}
        rows.append((key, ms + shift, seq, *[values[c] for c in CHANNELS]))
    return spark.createDataFrame(rows, SCHEMA)


def disordered(n: int, seed: int, hot: float = 0.0, late: float = 0.2):
    """Records in rough time order; some arrive late, and a share belongs to one key."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        ms = i * 700 - (rng.randrange(60_000) if rng.random() < late else rng.randrange(900))
        key = "HOT" if rng.random() < hot else f"S{rng.randrange(4)}"
        out.append((key, ms, {"snr_db": float(rng.randrange(40))}))
    return out


def watermarks(records, spec: WindowSpec):
    """Per record: largest earlier event time minus the delay, None for the first."""
    out, top = [], None
    for _, ms, *_more in records:
        out.append(None if top is None else top - spec.delay_ms)
        top = ms if top is None else max(top, ms)
    return out


def classes(records, spec: WindowSpec):
    out = []
    for (_, ms, *_more), wm in zip(records, watermarks(records, spec)):
        end = (ms // spec.size_ms + 1) * spec.size_ms
        if wm is not None and end + spec.lateness_ms <= wm:
            out.append("dead")
        elif wm is not None and end <= wm:
            out.append("late")
        else:
            out.append("on")
    return out


def emissions(records, spec: WindowSpec, channel: str = "snr_db"):
    """Set of (key, start, revision, count, late, min, max, sum) over all emissions."""
    windows: dict[tuple, list] = {}
    for record, cls in zip(records, classes(records, spec)):
        if cls != "dead":
            start = record[1] // spec.size_ms * spec.size_ms
            windows.setdefault((record[0], start), []).append((cls, record[2][channel]))
    out = set()
    for (key, start), members in windows.items():
        on = sum(cls == "on" for cls, _ in members)
        # Revision 0 holds all on-time records, or else the first late one.
        for revision, upto in enumerate(range(max(on, 1), len(members) + 1)):
            values = [v for _, v in members[:upto]]
            out.add(
                (key, start, revision, upto, upto - on, min(values), max(values), sum(values))
            )
    return out
