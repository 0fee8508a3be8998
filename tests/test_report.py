from __future__ import annotations

import random
import statistics

import pytest

from tidemark.operators.report import (
    anomalous_only,
    export_order,
    fire_order,
    for_key,
    max_per_key,
    panel_detail,
    panel_series,
    panel_totals,
    percentiles,
    top_anomalies,
    top_anomaly_per_key,
    top_values,
)

COLUMNS = (
    "sat_id string, window_start_ms long, is_anomaly int, temp_battery_c_max double, "
    "sample_count int, late_count int, anomaly_type string, snr_db_min double, "
    "attitude_error_deg_max double"
)


def results(spark, *items):
    """(key, start, is_anomaly, temperature)"""
    data = [(*i, 30, 1, "drift" if i[2] else "nominal", 14.0, 0.1) for i in items]
    return spark.createDataFrame(data, COLUMNS)


def test_best_anomalous_window_per_key(spark):
    df = results(
        spark,
        ("A", 0, 1, 40.0), ("A", 1, 1, 50.0), ("A", 2, 0, 99.0), ("A", 3, 1, 50.0),
        ("B", 0, 1, None), ("C", 0, 0, 70.0),
    )
    got = {r.sat_id: (r.window_start_ms, r.temp_battery_c_max)
           for r in top_anomaly_per_key(df).collect()}
    assert got == {"A": (1, 50.0), "B": (0, None)}
    assert {r.sat_id: r.m for r in max_per_key(df).collect()} == {"A": 50.0, "B": 0.0}
    assert anomalous_only(df).count() == 4
    assert for_key(df, sat_id="B").count() == 1


def test_top_twenty_in_order(spark):
    df = results(spark, *[(f"S{i:02}", 0, 1, float(i % 25)) for i in range(30)])
    rows = top_anomalies(df).collect()
    assert len(rows) == 20
    temps = [r.temp_battery_c_max for r in rows]
    assert temps == sorted(temps, reverse=True)
    assert [r.m for r in top_values(df).collect()] == temps


@pytest.mark.parametrize("p,want", [(0.0, 0.0), (0.5, 2.0), (1.0, 4.0), (0.95, 3.8)])
def test_percentile_interpolates(spark, p, want):
    df = spark.createDataFrame([(float(i),) for i in range(5)], "v double")
    assert percentiles(df, "v", {"p": p}).first()["p"] == pytest.approx(want)


def test_percentile_without_rows_is_zero(spark):
    df = spark.createDataFrame([], "v double")
    assert percentiles(df, "v", {"p": 0.5}).first()["p"] == 0.0


@pytest.mark.parametrize("target", [5, None])
def test_percentiles_of_repeated_and_spread_values(spark, target):
    rng = random.Random(1)
    values = [1.5] * 40 + [rng.expovariate(0.01) for _ in range(80)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = percentiles(df, "v", {"p50": 0.5, "p95": 0.95}, target=target).first()
    assert row.p50 == pytest.approx(statistics.median(values))
    assert row.p95 == pytest.approx(statistics.quantiles(values, n=20, method="inclusive")[18])


def test_panels(spark):
    df = results(spark, ("A", 30_000, 1, 40.0), ("B", 0, 0, 20.0))
    assert tuple(panel_totals(df).first()) == (2, 1, 2)
    assert tuple(panel_totals(df.where("false")).first()) == (0, 0, 0)
    assert panel_series(df).columns == ["time", "temp_battery_c_max", "sat_id"]
    assert panel_detail(df).columns == [
        "sat_id", "window_start", "samples", "late", "anomaly", "snr_min", "temp_max",
        "att_err_max",
    ]
    assert [r.sat_id for r in export_order(df).collect()] == ["A", "B"]
    assert [r.sat_id for r in fire_order(df).collect()] == ["B", "A"]


def test_percentiles_beside_an_infinity(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),)], "v double")
    row = percentiles(df, "v", {"p50": 0.5, "p0": 0.0, "p100": 1.0}).first()
    assert (row.p50, row.p0, row.p100) == (2.0, 1.0, float("inf"))
