from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.telemetry import classes, disordered, emissions, frame, watermarks
from tidemark.operators.lateness import (
    CLASS,
    annotate_lateness,
    dead_letters,
    partition_watermarks,
    run_summary,
    watermark_before,
    windows_changelog,
    windows_final,
)
from tidemark.operators.windows import telemetry_windows
from tidemark.schema import WindowSpec


def as_set(df):
    rows = df.select(
        "sat_id", "window_start_ms", "revision", "sample_count", "late_count",
        "snr_db_min", "snr_db_max",
        F.round(F.col("snr_db_avg") * F.col("sample_count")).alias("total"),
    ).collect()
    return {tuple(r) for r in rows}


def test_late_record_updates_its_window(spark):
    spec = WindowSpec(10_000, 0, 30_000)
    records = [
        ("A", 0, {"snr_db": 10.0}),
        ("A", 5_000, {"snr_db": 10.0}),
        ("A", 20_000),
        ("A", 3_000, {"snr_db": 40.0}),
    ]
    log = windows_changelog(annotate_lateness(frame(spark, records), spec), spec=spec)
    rows = log.where("window_start_ms = 0").orderBy("revision").collect()
    got = [(r.revision, r.sample_count, r.late_count, r.snr_db_max) for r in rows]
    assert got == [(0, 2, 0, 10.0), (1, 3, 1, 40.0)]


def test_too_late_record_is_kept_as_dead_letter(spark):
    spec = WindowSpec(10_000, 0, 5_000)
    df = frame(spark, [("A", 0), ("A", 100_000), ("A", 1_000)])
    dead = dead_letters(annotate_lateness(df, spec))
    assert [r.event_ts_ms for r in dead.collect()] == [1_000]
    assert set(df.columns) <= set(dead.columns)


def test_dead_letters_say_why_and_which_watermark_they_met(spark):
    spec = WindowSpec(10_000, 2_000, 5_000)
    df = frame(spark, [("A", 0), ("A", 100_000), ("A", 1_000), ("B", 200_000), ("B", 2_000)])
    annotated = annotate_lateness(df, spec)
    for target in (2, 100):
        rows = dead_letters(annotated, spec, target=target).orderBy("event_ts_ms").collect()
        assert [(r.event_ts_ms, r.reason, r.watermark_ms) for r in rows] == [
            (1_000, "past_allowed_lateness", 98_000),
            (2_000, "past_allowed_lateness", 198_000),
        ]


def test_watermark_trails_the_largest_event_time(spark):
    spec = WindowSpec(10_000, 3_000, 0)
    df = watermark_before(frame(spark, [("A", 5_000), ("A", 50_000), ("A", 50_001)]), spec)
    assert [r.watermark_ms for r in df.orderBy("ingest_seq").collect()] == [None, 2_000, 47_000]


def test_every_record_is_accounted_for(spark):
    spec = WindowSpec(10_000, 0, 60_000)
    records = [("A", 0), ("A", 20_000), ("A", 1_000), ("A", 2_000)]
    s = run_summary(annotate_lateness(frame(spark, records), spec)).first()
    assert s.on_time + s.late_accepted + s.dead_lettered == s.records_in == 4
    assert (s.late_accepted, s.windows_fired, s.window_updates) == (2, 2, 2)


def test_late_record_without_a_window_creates_it_at_revision_0(spark):
    spec = WindowSpec(10_000, 0, 60_000)
    records = [("B", 20_000), ("A", 1_000), ("A", 2_000)]
    log = windows_changelog(annotate_lateness(frame(spark, records), spec), spec=spec)
    rows = log.where("sat_id = 'A'").orderBy("revision").collect()
    assert [(r.revision, r.sample_count, r.late_count) for r in rows] == [(0, 1, 1), (1, 2, 2)]


def test_bounds_are_inclusive_and_zero_lateness_accepts_nothing_late(spark):
    at_end = [("A", 0), ("A", 10_000), ("A", 9_999)]
    def got(lateness):
        spec = WindowSpec(10_000, 0, lateness)
        df = annotate_lateness(frame(spark, at_end), spec)
        return [r[CLASS] for r in df.orderBy("ingest_seq").collect()]
    assert got(0) == ["on", "on", "dead"]
    assert got(1) == ["on", "on", "late"]


CASES = [
    (WindowSpec(10_000, 2_000, 10_000), dict(n=300, seed=1)),
    (WindowSpec(7_000, 0, 0), dict(n=200, seed=2)),
    (WindowSpec(30_000, 1_500, 25_000), dict(n=300, seed=3, hot=0.6)),
    (WindowSpec(5_000, 100, 50_000), dict(n=300, seed=4, hot=0.4, late=0.6)),
]


@pytest.mark.parametrize("spec,shape", CASES)
def test_same_as_record_by_record(spark, spec, shape):
    records = disordered(**shape)
    annotated = annotate_lateness(frame(spark, records), spec)
    got = [r[CLASS] for r in annotated.orderBy("ingest_seq").collect()]
    assert got == classes(records, spec)
    want = emissions(records, spec)
    assert as_set(windows_changelog(annotated, spec=spec)) == want
    last = {}
    for row in want:
        last[row[:2]] = max(row, last.get(row[:2], row), key=lambda r: r[2])
    assert as_set(windows_final(annotated, spec=spec)) == set(last.values())


@pytest.mark.parametrize("spec,shape", CASES[2:])
def test_hot_groups_are_divided_without_changing_results(
    spark, small_chunks, no_broadcast, spec, shape
):
    records = disordered(**shape)
    df = frame(spark, records)
    log = windows_changelog(annotate_lateness(df, spec), spec=spec)
    assert as_set(log) == emissions(records, spec)
    marks = watermark_before(df, spec).orderBy("ingest_seq").collect()
    assert [r.watermark_ms for r in marks] == watermarks(records, spec)


def test_a_record_without_a_time_is_dead_and_closes_nothing(spark):
    spec = WindowSpec(10_000, 2_000, 20_000)
    df = frame(spark, [("A", 1_000), ("A", 0), ("A", 50_000), ("A", 2_000)])
    df = df.withColumn("event_ts_ms", F.when(F.col("ingest_seq") != 1, F.col("event_ts_ms")))
    annotated = annotate_lateness(df, spec)
    got = [r[CLASS] for r in annotated.orderBy("ingest_seq").collect()]
    assert got == ["on", "dead", "on", "dead"]
    dead = dead_letters(annotated, spec).orderBy("ingest_seq").collect()
    assert [(r.reason, r.watermark_ms) for r in dead] == [
        ("missing_event_time", -1_000),
        ("past_allowed_lateness", 48_000),
    ]
    s = run_summary(annotated).first()
    assert (s.records_in, s.on_time, s.dead_lettered, s.windows_fired) == (4, 2, 2, 2)
    starts = {r.window_start_ms for r in windows_final(annotated, spec=spec).collect()}
    assert starts == {0, 50_000}
    assert {r.window_start_ms for r in telemetry_windows(df, spec=spec).collect()} == starts
    only = df.where("ingest_seq = 1")
    assert [r[CLASS] for r in annotate_lateness(only, spec).collect()] == ["dead"]


def test_partitions_have_watermarks_of_their_own(spark):
    spec = WindowSpec(10_000, 1_000, 5_000)
    rows = [
        ("b", 0, 1_000, 1),
        ("a", 1, 5_000, 2),
        ("a", 2, 40_000, 3),  # b holds the watermark back
        ("b", 3, 2_000, 4),
        ("a", 4, 41_000, 100),  # b has been silent for too long
        ("b", 5, None, 101),  # and is back, with no more than it had
        ("a", 6, 42_000, 102),
        ("c", 7, 30_000, 103),
        ("a", 8, 43_000, 104),
    ]
    df = spark.createDataFrame(rows, "part string, seq long, event_ts_ms long, at long")
    more = dict(order=["seq"], arrival="at", idle_ms=50)
    marked, after = partition_watermarks(df, ["part"], spec, **more)
    want = [None, 0, 0, 0, 1_000, 40_000, 40_000, 40_000, 40_000]
    assert [r.watermark_ms for r in marked.orderBy("seq").collect()] == want
    assert after.top_ms == 41_000 and after.reached['{"part":"b"}'] == (2_000, 101)
    for cut in (1, 4, 6):
        first, seen = partition_watermarks(df.where(F.col("seq") < cut), ["part"], spec, **more)
        rest, end = partition_watermarks(df.where(F.col("seq") >= cut), ["part"], spec, seen=seen, target=2, **more)
        both = first.unionByName(rest).orderBy("seq").collect()
        assert [r.watermark_ms for r in both] == want and end == after


def test_two_column_order_breaks_ties_by_the_second(spark):
    spec = WindowSpec(10_000, 0, 0)
    rows = [("A", 0, 5, 2), ("A", 50_000, 5, 1), ("A", 60_000, -3, 9)]
    df = spark.createDataFrame(rows, "sat_id string, event_ts_ms long, arrival long, id long")
    marks = watermark_before(df, spec, ("arrival", "id")).orderBy("arrival", "id").collect()
    assert [r.watermark_ms for r in marks] == [None, 60_000, 60_000]
    assert [r.id for r in marks] == [9, 1, 2]


def test_classification_does_not_shuffle_records(spark):
    spec = WindowSpec()
    annotated = annotate_lateness(frame(spark, disordered(50, 5)), spec)
    plan = annotated._jdf.queryExecution().executedPlan().toString()
    big_side = plan[: plan.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in big_side and "BroadcastHashJoin" in big_side


def test_hot_window_start_is_salted_when_not_broadcast(spark, no_broadcast):
    spec = WindowSpec()
    records = disordered(200, 6, hot=0.5)
    annotated = annotate_lateness(frame(spark, records), spec)
    assert "_salt" in annotated._jdf.queryExecution().optimizedPlan().toString()
    got = [r[CLASS] for r in annotated.orderBy("ingest_seq").collect()]
    assert got == classes(records, spec)
