from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tests.telemetry import frame
from tidemark.functions import (
    classify,
    nan_to_null,
    null_to_zero,
    record_id,
    window_end,
    window_start,
)
from tidemark.operators.lateness import annotate_lateness, windows_final
from tidemark.operators.windows import telemetry_windows
from tidemark.schema import CHANNELS, RULES, WindowSpec, result_schema


def one(df, c):
    return df.select(c.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "ms,start", [(0, 0), (29_999, 0), (30_000, 30_000), (75_000, 60_000), (-1, -30_000)]
)
def test_window_bounds_floor_and_are_half_open(spark, ms, start):
    c = F.lit(ms).cast("long")
    assert one(spark.range(1), window_start(c, 30_000)) == start
    assert one(spark.range(1), window_end(c, 30_000)) == start + 30_000


def test_records_are_grouped_by_key_and_window(spark):
    df = frame(spark, [("A", 0), ("B", 0), ("A", 5_000), ("A", 9_999), ("A", 10_000)])
    out = telemetry_windows(df, spec=WindowSpec(10_000, 0, 0))
    got = {(r.sat_id, r.window_start_ms): r.sample_count for r in out.collect()}
    assert got == {("A", 0): 3, ("B", 0): 1, ("A", 10_000): 1}


def test_nan_reading_is_missing_in_every_window(spark):
    nan = float("nan")
    values = [("A", 0, {"snr_db": nan}), ("A", 1, {"snr_db": 20.0}), ("A", 2, {"snr_db": nan, "temp_battery_c": nan})]
    df, spec = frame(spark, values), WindowSpec(10_000, 0, 0)
    for out in (telemetry_windows(df, spec=spec), windows_final(annotate_lateness(df, spec), spec=spec)):
        row = out.first()
        assert (row.snr_db_min, row.snr_db_avg, row.snr_db_max) == (20.0, 20.0, 20.0)
        assert row.anomaly_type == "nominal" and row.sample_count == 3


def test_statistics_key_and_schema(spark):
    values = [("A", 0, {"snr_db": 10.0}), ("A", 1, {"snr_db": 20.0}), ("A", 2, {"snr_db": 30.0})]
    out = telemetry_windows(frame(spark, values), spec=WindowSpec(10_000, 0, 0))
    row = out.first()
    assert (row.snr_db_min, row.snr_db_avg, row.snr_db_max) == (10.0, 20.0, 30.0)
    assert row.result_key == "A:0" and row.window_end_ms == 10_000
    assert out.columns == result_schema().names
    assert [f.dataType for f in out.schema] == [f.dataType for f in result_schema()]


def test_missing_readings_are_skipped(spark):
    df = frame(
        spark,
        [
            ("A", 0, {"snr_db": None, "temp_battery_c": None}),
            ("A", 1, {"snr_db": 8.0, "temp_battery_c": None}),
        ],
    )
    row = telemetry_windows(df).first()
    assert (row.snr_db_avg, row.sample_count) == (8.0, 2)
    assert row.temp_battery_c_max is None and row.anomaly_type == "nominal"


@pytest.mark.parametrize(
    "override,label",
    [
        ({}, "nominal"),
        ({"attitude_error_deg_max": 0.9}, "drift"),
        ({"attitude_error_deg_max": 0.5}, "nominal"),
        ({"snr_db_min": 2.0}, "dropout"),
        ({"temp_battery_c_max": 45.0}, "thermal_runaway"),
        (
            {"attitude_error_deg_max": 0.9, "snr_db_min": 2.0, "temp_battery_c_max": 45.0},
            "thermal_runaway",
        ),
        ({"temp_battery_c_max": None, "snr_db_min": 2.0}, "dropout"),
    ],
)
def test_first_rule_that_holds_labels_the_window(spark, override, label):
    stats = {"attitude_error_deg_max": 0.05, "snr_db_min": 14.0, "temp_battery_c_max": 19.0}
    schema = ", ".join(f"{c} double" for c in stats)
    df = spark.createDataFrame([tuple({**stats, **override}.values())], schema)
    assert one(df, classify(RULES)) == label


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(math.nan, None)], "a double, b double")
    assert one(df, nan_to_null(F.col("a"))) is None
    assert one(df, null_to_zero(F.col("b"))) == 0.0
    assert one(df, record_id(F.lit("A"), F.lit(7).cast("long"))) == "A:00000007"
    long = record_id(F.lit("A"), F.lit(1_234_567_890).cast("long"))
    assert one(df, long) == "A:1234567890"


def test_windows_open_at_the_end_are_included(spark):
    spec = WindowSpec(10_000, 5_000, 0)
    out = windows_final(annotate_lateness(frame(spark, [("A", 0), ("A", 1_000)]), spec), spec=spec)
    assert [r.sample_count for r in out.collect()] == [2]


def test_channel_list_is_complete():
    assert len(CHANNELS) == len(set(CHANNELS)) == 14


def test_aggregation_moves_only_partial_aggregates(spark):
    plan = telemetry_windows(frame(spark, [("A", 0)]))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("HashAggregate")


def test_bad_window_parameters_are_refused():
    with pytest.raises(ValueError):
        WindowSpec(size_ms=0)
    with pytest.raises(ValueError):
        WindowSpec(delay_ms=-1)
