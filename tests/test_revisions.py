from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.operators.revisions import (
    advance_offsets,
    committed_offset,
    distinct_keys,
    drop_redelivered,
    fence,
    fence_by,
    fenced_outcomes,
    fenced_outcomes_by,
    having_keys,
    keep_latest,
    outcome_counts,
    sink_outcomes,
    without_keys,
)


def rows(spark, *items):
    """(key, start, revision, count) in order of arrival."""
    data = [(*item, seq) for seq, item in enumerate(items)]
    return spark.createDataFrame(
        data,
        "sat_id string, window_start_ms long, revision int, sample_count int, seq long",
    )


def held(df):
    return sorted((r.sat_id, r.window_start_ms, r.revision, r.sample_count) for r in df.collect())


def counts(df):
    return tuple(outcome_counts(df).first())


def test_first_row_is_inserted(spark):
    df = rows(spark, ("A", 0, 0, 1))
    assert held(keep_latest(df)) == [("A", 0, 0, 1)]
    assert counts(sink_outcomes(df)) == (1, 0, 0)


def test_equal_revision_changes_nothing(spark):
    df = rows(spark, ("A", 0, 0, 2), ("A", 0, 0, 9))
    assert held(keep_latest(df)) == [("A", 0, 0, 2)]
    assert counts(sink_outcomes(df)) == (1, 1, 0)


def test_higher_revision_replaces(spark):
    assert held(keep_latest(rows(spark, ("A", 0, 0, 2), ("A", 0, 1, 3)))) == [("A", 0, 1, 3)]


def test_lower_revision_is_stale(spark):
    df = rows(spark, ("A", 0, 2, 5), ("A", 0, 1, 99))
    assert held(keep_latest(df)) == [("A", 0, 2, 5)]
    assert counts(sink_outcomes(df)) == (1, 0, 1)


def test_replay_of_everything_changes_nothing(spark):
    once = [("A", 0, 0, 1), ("B", 0, 0, 1), ("A", 30_000, 0, 1), ("A", 0, 1, 4)]
    assert held(keep_latest(rows(spark, *once))) == held(keep_latest(rows(spark, *once, *once)))


def test_offset_fence(spark):
    df = rows(spark, ("A", 0, 0, 1), ("B", 0, 0, 1), ("B", 30_000, 0, 1))
    assert [r.seq for r in fence(df, "seq", 1).collect()] == [2]
    assert counts(fenced_outcomes(df, "seq", 1)) == (1, 2, 0)
    assert committed_offset(df, "seq", -1) == 2
    assert committed_offset(df.where("seq < 0"), "seq", 7) == 7
    assert committed_offset(df, "seq", 9) == 9


def test_each_partition_has_its_own_fence(spark):
    data = [(p, at, f"{p}{at}", 0, 0, 10 * at + i) for i, p in enumerate(("a", "b", None)) for at in range(4)]
    df = spark.createDataFrame(data, "part string, at long, sat_id string, window_start_ms long, revision int, seq long")
    offsets = spark.createDataFrame([("a", 1), (None, 2)], "part string, committed long")
    ahead = sorted((r.part or "", r["at"]) for r in fence_by(df, offsets, ["part"], "at").collect())
    assert ahead == [("", 3), ("a", 2), ("a", 3), ("b", 0), ("b", 1), ("b", 2), ("b", 3)]
    assert counts(fenced_outcomes_by(df, offsets, ["part"], "at")) == (7, 5, 0)
    moved = advance_offsets(offsets, df.where("at < 2"), ["part"], "at")
    assert {(r.part, r.committed) for r in moved.collect()} == {("a", 1), ("b", 1), (None, 2)}
    again = advance_offsets(moved, df.where("at < 2"), ["part"], "at")
    assert again.exceptAll(moved).isEmpty() and moved.exceptAll(again).isEmpty()
    # Delivered again, everything committed is a duplicate and changes nothing.
    done = advance_offsets(moved, df, ["part"], "at")
    assert counts(fenced_outcomes_by(df, done, ["part"], "at")) == (0, 12, 0)


def test_outcomes_of_a_hot_key_match_one_by_one_application(spark, small_chunks):
    rng = random.Random(3)
    items = [("H" if rng.random() < 0.6 else "C", 0, rng.randrange(30), 1) for _ in range(150)]
    best, want = {}, []
    for key, _, revision, _ in items:
        top = best.get(key)
        if top is None or revision > top:
            want.append("applied")
            best[key] = revision
        else:
            want.append("ignored_duplicate" if revision == top else "ignored_stale")
    out = sink_outcomes(rows(spark, *items)).orderBy("seq").collect()
    assert [r.outcome for r in out] == want


def test_keys_are_matched_as_pairs(spark):
    df = rows(spark, ("A", 0, 0, 1), ("A", 1, 0, 1), ("B", 0, 0, 1), ("B", 1, 0, 1))
    gone = rows(spark, ("A", 0, 0, 1), ("B", 1, 0, 1))
    assert held(without_keys(df, gone)) == [("A", 1, 0, 1), ("B", 0, 0, 1)]
    assert held(having_keys(df, gone)) == [("A", 0, 0, 1), ("B", 1, 0, 1)]
    assert sorted(r.sat_id for r in distinct_keys(df, "sat_id").collect()) == ["A", "B"]


def test_redelivered_records_are_dropped_on_request(spark):
    df = spark.createDataFrame([("A:1",), ("A:1",), ("A:2",)], "record_id string")
    assert drop_redelivered(df).count() == 2


def test_copies_of_one_key_shrink_before_the_exchange(spark):
    df = spark.range(1000).select(
        (F.col("id") % 3).alias("sat_id"), F.lit(0).alias("window_start_ms"),
        F.col("id").alias("revision"), F.col("id").alias("seq"),
    )
    plan = keep_latest(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
