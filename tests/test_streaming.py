from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.telemetry import SHIFT, disordered, frame
from tidemark.operators.lateness import (
    annotate_lateness,
    classify_by_watermark,
    dead_letters,
    partition_watermarks,
    windows_changelog,
    windows_final,
)
from tidemark.operators.windows import telemetry_windows
from tidemark.schema import WindowSpec
from tidemark.sources.files import replay
from tidemark.streaming.exact import ExactLateWindows, start_exact
from tidemark.streaming.native import drop_redelivered_stream, native_windows
from tidemark.streaming.redelivery import first_deliveries, merged, seen_ranges, within
from tidemark.streaming.stateful import (
    DEAD,
    KIND,
    RESULT,
    late_windows_stream,
    open_windows,
    rocksdb_state,
    window_results,
)

SPEC = WindowSpec(10_000, 2_000, 20_000)
RECORDS = disordered(160, 11, hot=0.4, late=0.3)


@pytest.fixture
def rocksdb(spark):
    with rocksdb_state(spark):
        yield


def same(a, b):
    columns = [c for c in b.columns if not c.endswith("_avg")]
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def feed(df, folder, cuts):
    """Append the records between successive cuts of arrival order, one step at a time."""
    for low, high in zip((0, *cuts), (*cuts, 10**9)):
        df.where(F.col("ingest_seq").between(low, high - 1)).coalesce(1).write.mode(
            "append"
        ).parquet(folder)
        yield


def test_carried_windows_take_no_exchange_of_their_own(spark, tmp_path):
    sink = ExactLateWindows(str(tmp_path), spec=SPEC)
    annotated = annotate_lateness(frame(spark, RECORDS, SHIFT), SPEC)
    groups = sink._with_state(annotated, None)
    state = sink._kept(groups, None)
    both = sink._with_state(annotated, state.localCheckpoint())
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    # Each window comes once from the records and once from the state.
    on = groups.where("_late_at is null").select("sat_id", "window_start_ms", "_on", "snr_db_sum")
    added = on.join(state.select("sat_id", "window_start_ms", *(F.col(c).alias(f"{c}_2") for c in ("_on", "snr_db_sum"))), ["sat_id", "window_start_ms"], "full")
    total = [(F.coalesce(c, F.lit(0)) + F.coalesce(f"{c}_2", F.lit(0))).alias(c) for c in ("_on", "snr_db_sum")]
    got = both.where("_late_at is null").select("sat_id", "window_start_ms", "_on", "snr_db_sum")
    assert same(got, added.select("sat_id", "window_start_ms", *total))
    # Only windows with late records can have more than one row.
    sizes = {tuple(r)[:2]: r.n for r in sink._sizes(groups).collect()}
    rows = groups.groupBy("sat_id", "window_start_ms").count().collect()
    assert sizes and all(r["count"] <= sizes.get(tuple(r)[:2], 1) for r in rows)


def per_batch(path):
    return lambda df, batch_id: df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def run(writer, checkpoint):
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


@pytest.mark.parametrize("cuts", [(), (37, 38, 120)])
def test_exact_stream_equals_batch_wherever_it_is_cut(spark, tmp_path, cuts):
    df = frame(spark, RECORDS, SHIFT)
    sink = ExactLateWindows(str(tmp_path / "out"), spec=SPEC)
    last = -1
    for last, _ in enumerate(feed(df, str(tmp_path / "in"), cuts)):
        stream = replay(spark, str(tmp_path / "in"), df.schema)
        start_exact(stream, sink, str(tmp_path / "ck"), availableNow=True).awaitTermination()
    sink.flush(spark, last)
    annotated = annotate_lateness(df, SPEC)
    assert same(sink.changelog(spark), windows_changelog(annotated, spec=SPEC))
    assert same(sink.latest(spark), windows_final(annotated, spec=SPEC))
    assert same(sink.dead_letters(spark), dead_letters(annotated))
    total = sink.counters(spark).first()
    assert total.on_time + total.late_accepted + total.dead_lettered == len(RECORDS)


def test_running_a_batch_again_changes_nothing(spark, tmp_path):
    df = frame(spark, RECORDS, SHIFT)
    sink = ExactLateWindows(str(tmp_path / "out"), spec=SPEC)
    halves = [df.where("ingest_seq < 80"), df.where("ingest_seq >= 80")]
    for batch_id in (0, 1, 1):
        sink(halves[batch_id], batch_id)
    sink.flush(spark, 1)
    want = windows_changelog(annotate_lateness(df, SPEC), spec=SPEC)
    assert same(sink.changelog(spark), want)


def test_state_keeps_only_windows_that_can_change(spark, tmp_path):
    df = frame(spark, RECORDS, SHIFT)
    sink = ExactLateWindows(str(tmp_path / "out"), spec=SPEC)
    sink(df, 0)
    newest = df.agg(F.max("event_ts_ms")).first()[0]
    over = newest - SPEC.delay_ms - SPEC.lateness_ms
    kept = sink.state(spark, 0)
    assert kept.where(F.col("window_start_ms") + SPEC.size_ms <= over).isEmpty()
    assert 0 < kept.count() < windows_final(annotate_lateness(df, SPEC), spec=SPEC).count()


def test_empty_batch_carries_state_over(spark, tmp_path):
    df = frame(spark, RECORDS, SHIFT)
    sink = ExactLateWindows(str(tmp_path / "out"), spec=SPEC)
    sink(df, 0)
    sink(df.where("false"), 1)
    assert same(sink.state(spark, 1), sink.state(spark, 0))
    sink.forget(spark, 1)
    sink(df.where("false"), 2)
    assert sink.state(spark, 2).count() == sink.state(spark, 1).count()
    with pytest.raises(Exception):
        sink.state(spark, 0)


@pytest.mark.parametrize("salts", [1, 3])
def test_keyed_state_accounts_for_every_record(spark, tmp_path, salts, rocksdb):
    df = frame(spark, RECORDS, SHIFT)
    for _ in feed(df, str(tmp_path / "in"), (60, 110)):
        out = late_windows_stream(
            replay(spark, str(tmp_path / "in"), df.schema),
            spec=SPEC,
            spread="ingest_seq",
            salts=salts,
        )
        writer = out.writeStream.outputMode("append").foreachBatch(per_batch(tmp_path / "out"))
        run(writer, str(tmp_path / "ck"))
    emitted = spark.read.parquet(str(tmp_path / "out"))
    left = open_windows(spark, str(tmp_path / "ck"))
    results = window_results(emitted.unionByName(left, allowMissingColumns=True), spec=SPEC)
    dead = emitted.where(F.col(KIND) == DEAD)
    assert dead.count() > 0
    assert results.agg(F.sum("sample_count")).first()[0] + dead.count() == len(RECORDS)
    # No record was counted in a window it does not belong to: batch-wise lateness only
    # moves records between the accepted and the dead.
    accepted = df.join(dead.select("ingest_seq"), "ingest_seq", "left_anti")
    plain = telemetry_windows(accepted, spec=SPEC)
    columns = ["sat_id", "window_start_ms", "sample_count", "snr_db_min", "snr_db_max"]
    assert same(results.select(*columns), plain.select(*columns))


def test_keyed_state_with_one_record_per_batch_equals_batch(spark, tmp_path, rocksdb):
    spec = WindowSpec(10_000, 0, 30_000)
    records = [
        ("A", 0, {"snr_db": 10.0}),
        ("A", 20_000),
        ("A", 3_000, {"snr_db": 40.0}),
        ("B", 4_000, {"snr_db": 7.0}),
        ("A", 60_000),
        ("A", 1_000),
    ]
    df = frame(spark, records, SHIFT)
    for _ in feed(df, str(tmp_path / "in"), range(1, len(records))):
        out = late_windows_stream(replay(spark, str(tmp_path / "in"), df.schema), spec=spec)
        writer = out.writeStream.outputMode("append").foreachBatch(per_batch(tmp_path / "out"))
        run(writer, str(tmp_path / "ck"))
    emitted = spark.read.parquet(str(tmp_path / "out"))
    annotated = annotate_lateness(df, spec)
    left = open_windows(spark, str(tmp_path / "ck"))
    both = emitted.unionByName(left, allowMissingColumns=True)
    assert same(window_results(both, spec=spec), windows_final(annotated, spec=spec))
    dead = emitted.where(F.col(KIND) == DEAD).select("ingest_seq").collect()
    assert [r.ingest_seq for r in dead] == [5]
    fired = emitted.where(F.col(KIND) == RESULT).select("sat_id", "window_start_ms", "_late")
    log = windows_changelog(annotated, spec=spec)
    on_watermark = log.where(F.col("window_start_ms") < SHIFT + 60_000)
    assert fired.count() == on_watermark.count()


DAY_MS = 24 * 3_600_000


def test_no_record_is_lost_however_late(spark, tmp_path, rocksdb):
    now = 500 * DAY_MS
    first = [("A", now), ("A", now + 60_000)]
    old = [("A", now - 10 * DAY_MS), ("A", now - 40 * DAY_MS), ("B", now - 400 * DAY_MS)]
    outside = [("A", -5 * DAY_MS), ("B", 120 * 365 * DAY_MS)]
    df = frame(spark, first + old + outside)
    for _ in feed(df, str(tmp_path / "in"), (len(first),)):
        out = late_windows_stream(replay(spark, str(tmp_path / "in"), df.schema), spec=SPEC)
        writer = out.writeStream.outputMode("append").foreachBatch(per_batch(tmp_path / "out"))
        run(writer, str(tmp_path / "ck"))
    emitted = spark.read.parquet(str(tmp_path / "out"))
    dead = emitted.where(F.col(KIND) == DEAD).select("event_ts_ms").collect()
    assert sorted(r.event_ts_ms for r in dead) == sorted(ms for _, ms in old + outside)
    left = open_windows(spark, str(tmp_path / "ck"))
    results = window_results(emitted.unionByName(left, allowMissingColumns=True), spec=SPEC)
    assert results.agg(F.sum("sample_count")).first()[0] == len(first)


def test_counters_are_those_of_one_query(spark, tmp_path):
    df = frame(spark, RECORDS, SHIFT)
    one, other = (ExactLateWindows(str(tmp_path / "out"), query_id=i, spec=SPEC) for i in "12")
    one(df, 0)
    one.flush(spark, 0)
    before = one.counters(spark).first()
    other(df, 0)
    other.flush(spark, 0)
    assert one.counters(spark).first() == before
    assert one.changelog(spark, every_query=True).count() == 2 * one.changelog(spark).count()


def test_a_batch_out_of_order_and_a_fresh_start_are_refused(spark, tmp_path):
    df = frame(spark, RECORDS, SHIFT)
    sink = ExactLateWindows(str(tmp_path / "out"), spec=SPEC)
    sink(df.where("ingest_seq between 50 and 90"), 0)
    with pytest.raises(ValueError, match="arrival order"):
        sink(df.where("ingest_seq < 60"), 1)
    sink(df.where("ingest_seq > 90"), 1)
    with pytest.raises(ValueError, match="of its own"):
        sink(df, 0)


def test_records_without_a_time_are_dead_letters_and_counted(spark, tmp_path):
    df = frame(spark, [("A", 1_000), ("A", 0), ("A", 50_000), ("A", 2_000)], SHIFT)
    df = df.withColumn("event_ts_ms", F.when(F.col("ingest_seq") != 1, F.col("event_ts_ms")))
    for name, cuts in (("one", [4]), ("each", [1, 2, 3, 4])):
        sink = ExactLateWindows(str(tmp_path / name), spec=SPEC)
        for batch_id, (low, high) in enumerate(zip([0, *cuts], cuts)):
            sink(df.where(F.col("ingest_seq").between(low, high - 1)), batch_id)
        sink.flush(spark, batch_id)
        assert sorted(r.ingest_seq for r in sink.dead_letters(spark).collect()) == [1, 3]
        total = sink.counters(spark).first()
        assert (total.records_in, total.on_time, total.dead_lettered, total.windows_fired) == (4, 2, 2, 2)


def test_readers_see_committed_batches_only(spark, tmp_path, monkeypatch):
    df = frame(spark, RECORDS, SHIFT)
    sink = ExactLateWindows(str(tmp_path / "out"), spec=SPEC)
    halves = [df.where("ingest_seq < 80"), df.where("ingest_seq >= 80")]
    sink(halves[0], 0)
    views = lambda: (
        sorted(map(tuple, sink.changelog(spark).select("result_key", "revision").collect())),
        sorted(r.ingest_seq for r in sink.dead_letters(spark).collect()),
        sink.counters(spark).first(),
    )
    before = views()

    def lost(*_):
        raise OSError("the driver is gone")

    for step in ("_emitted", "_kept", "_commit"):
        with monkeypatch.context() as broken:
            broken.setattr(ExactLateWindows, step, lost)
            with pytest.raises(OSError):
                sink(halves[1], 1)
        assert views() == before
    sink(halves[1], 1)
    annotated = annotate_lateness(df, SPEC)
    assert views()[2].records_in == len(RECORDS)
    assert same(sink.dead_letters(spark), dead_letters(annotated))
    # A flush that fails isn't there either, and a batch in place of one takes it back.
    after = views()
    sink.flush(spark, 1)
    assert len(views()[0]) > len(after[0])
    with monkeypatch.context() as broken:
        broken.setattr(ExactLateWindows, "_commit", lost)
        with pytest.raises(OSError):
            sink(df.where("false"), 2)
    assert views() == after


@pytest.mark.parametrize("cuts", [{"a": [150], "b": [150]}, {"a": [20, 100, 150], "b": [90, 90, 150]}, {"a": [0, 150], "b": [70, 150]}])
def test_partitions_may_be_cut_anywhere(spark, tmp_path, cuts):
    df = frame(spark, RECORDS, SHIFT).withColumn("part", F.when(F.col("ingest_seq") % 3 == 0, "a").otherwise("b"))
    more = dict(spec=SPEC, source=["part"], idle_ms=6, expected=[("a",), ("b",)])
    sink = ExactLateWindows(str(tmp_path / "out"), **more)
    taken = {"a": 0, "b": 0}
    for batch_id in range(len(cuts["a"])):
        arrives = F.lit(False)
        for part, ends in cuts.items():
            arrives = arrives | ((F.col("part") == part) & F.col("ingest_seq").between(taken[part], ends[batch_id] - 1))
            taken[part] = ends[batch_id]
        sink(df.where(arrives), batch_id)
    sink.flush(spark, batch_id)
    whole = df.where("ingest_seq < 150")
    marked, _ = partition_watermarks(whole, ["part"], SPEC, idle_ms=6)
    annotated = classify_by_watermark(marked, SPEC)
    assert same(sink.changelog(spark), windows_changelog(annotated, spec=SPEC))
    assert same(sink.dead_letters(spark), dead_letters(annotated).drop("watermark_ms"))
    assert sink.counters(spark).first().records_in == 150


def test_a_partition_that_stays_away_is_not_waited_for(spark, tmp_path):
    df = frame(spark, RECORDS, SHIFT).withColumn("part", F.when(F.col("ingest_seq") % 3 == 0, "a").otherwise("b"))
    sink = ExactLateWindows(str(tmp_path / "out"), spec=SPEC, source=["part"], idle_ms=6, wait_ms=30)
    sink(df.where("part = 'b' or ingest_seq < 9"), 0)
    assert sink.counters(spark).first().records_in > 90
    sink(df.where("part = 'a' and ingest_seq >= 9"), 1)
    sink.flush(spark, 1)
    total = sink.counters(spark).first()
    assert total.records_in == len(RECORDS) == total.on_time + total.late_accepted + total.dead_lettered


def test_compaction_leaves_every_view_as_it_was(spark, tmp_path, monkeypatch):
    df = frame(spark, RECORDS, SHIFT)
    path = tmp_path / "out"
    sink, other = (ExactLateWindows(str(path), query_id=i, spec=SPEC) for i in ("main", "other"))
    other(df, 0)
    for batch_id in range(6):
        sink(df.where(F.col("ingest_seq").between(25 * batch_id, 25 * batch_id + 24)), batch_id)
    views = lambda: (
        sorted(map(str, sink.changelog(spark).drop("batch_id").collect())),
        sorted(map(str, sink.dead_letters(spark, every_query=True).drop("batch_id").collect())),
        sink.counters(spark).first(),
    )
    files = lambda: len(list(path.glob("changelog/query_id=main/*/*.parquet")))
    before, many = views(), files()
    reader = sink.changelog(spark)
    assert sink.compact(spark, 3) == 3 and views() == before
    assert sink.compact(spark, 3) == 0
    assert len(reader.collect()) == len(before[0])  # a reader that began before
    with monkeypatch.context() as broken:
        broken.setattr("tidemark.sinks.changelog.write_text", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sink.compact(spark, 5)
    assert views() == before
    assert sink.compact(spark, 5) == 3 and views() == before  # one of three batches, and two
    assert files() < many
    left = {p.name for p in path.glob("changelog/query_id=main/*")}
    assert left == {"batch_id=-5", "batch_id=-3", "batch_id=3", "batch_id=4", "batch_id=5"}
    sink(df.where("ingest_seq >= 150"), 6)
    sink.flush(spark, 6)
    annotated = annotate_lateness(df, SPEC)
    assert same(sink.changelog(spark), windows_changelog(annotated, spec=SPEC))


def test_flush_of_a_stream_without_batches(spark, tmp_path):
    ExactLateWindows(str(tmp_path / "out"), spec=SPEC).flush(spark, -1)
    assert not (tmp_path / "out").exists()


def test_native_modes(spark, tmp_path):
    in_order = frame(spark, [("A", i * 1_000) for i in range(60)], SHIFT)
    folder = str(tmp_path / "in")
    for _ in feed(in_order, folder, (25,)):
        pass
    stream = replay(spark, folder, in_order.schema, max_files=1)
    results = native_windows(stream, spec=SPEC)
    batch = telemetry_windows(in_order, spec=SPEC)

    out = str(tmp_path / "final")
    run(results.writeStream.outputMode("append").format("parquet").option("path", out), out + "ck")
    closed = batch.where(F.col("window_end_ms") <= SHIFT + 59_000 - 22_000)
    assert same(spark.read.schema(results.schema).parquet(out), closed)

    log = str(tmp_path / "update")
    run(results.writeStream.outputMode("update").foreachBatch(per_batch(log)), log + "ck")
    newest = spark.read.parquet(log).groupBy("sat_id", "window_start_ms").agg(
        F.max("sample_count").alias("sample_count")
    )
    assert same(newest, batch.select("sat_id", "window_start_ms", "sample_count"))


def test_stream_drops_redelivered_records(spark, tmp_path):
    df = frame(spark, [("A", 0), ("A", 1_000), ("A", 1_000)], SHIFT).withColumn(
        "record_id", F.concat_ws(":", "sat_id", "event_ts_ms")
    )
    df.write.parquet(str(tmp_path / "in"))
    stream = replay(spark, str(tmp_path / "in"), df.schema)
    out = str(tmp_path / "out")
    writer = drop_redelivered_stream(stream, 60_000).writeStream.format("parquet")
    run(writer.option("path", out), str(tmp_path / "ck"))
    assert spark.read.parquet(out).count() == 2


def test_ranges_of_numbers_equal_a_set():
    rng = random.Random(3)
    ranges, seen = np.zeros((0, 2), np.int64), set()
    for _ in range(40):
        numbers = np.array([rng.randrange(-60, 60) for _ in range(rng.randrange(6))], np.int64)
        assert within(ranges, numbers).tolist() == [n in seen for n in numbers.tolist()]
        ranges = merged(ranges, numbers)
        seen |= set(numbers.tolist())
        held = [n for low, high in ranges.tolist() for n in range(low, high + 1)]
        assert held == sorted(seen)
        assert all(b - 1 > a for a, b in zip(ranges[:-1, 1], ranges[1:, 0]))


def test_no_copy_passes_however_late_and_state_is_as_large_as_the_gaps(spark, tmp_path, rocksdb):
    rng = random.Random(6)
    order = [(k, n) for k in ("A", "B", None) for n in range(40) if (k, n) != ("B", 17)]
    rng.shuffle(order)
    rows = [*order, *order[:50], ("A", None), ("A", None), *order]
    df = spark.createDataFrame([(k, n, i) for i, (k, n) in enumerate(rows)], "sat_id string, n long, ingest_seq long")
    for _ in feed(df, str(tmp_path / "in"), (70, 150, 200)):
        passed = first_deliveries(replay(spark, str(tmp_path / "in"), df.schema), "n", block_numbers=32)
        writer = passed.writeStream.outputMode("append").format("parquet")
        run(writer.option("path", str(tmp_path / "out")), str(tmp_path / "ck"))
    out = [(r.sat_id, r.n) for r in spark.read.schema(df.schema).parquet(str(tmp_path / "out")).collect()]
    assert sorted(out, key=str) == sorted([*order, ("A", None), ("A", None)], key=str)
    left = [tuple(r) for r in seen_ranges(spark, str(tmp_path / "ck")).collect()]
    want = [(k, 0, 0, 31) for k in ("A", None)] + [(k, 1, 32, 39) for k in ("A", "B", None)]
    assert sorted(left, key=str) == sorted([*want, ("B", 0, 0, 16), ("B", 0, 18, 31)], key=str)


def test_state_is_kept_by_share_not_by_key(spark, tmp_path, rocksdb):
    """As many reads and writes of state as there are shares, however many keys there are."""
    keys = [None, *range(40)]
    rows = [(k, SHIFT + t * 1_000, t, float(t)) for t in (0, 3, 60) for k in keys]
    schema = "sat long, event_ts_ms long, ingest_seq long, x double"
    df = spark.createDataFrame(rows, schema)
    for _ in feed(df, str(tmp_path / "in"), (50,)):
        stream = replay(spark, str(tmp_path / "in"), df.schema)
        out = late_windows_stream(stream, keys=["sat"], channels=["x"], spec=SPEC, shares=3)
        writer = out.writeStream.outputMode("append").foreachBatch(per_batch(tmp_path / "out"))
        run(writer, str(tmp_path / "ck"))
    held = spark.read.format("statestore").option("stateVarName", "open").load(str(tmp_path / "ck"))
    assert 1 <= held.count() <= 3
    left = open_windows(spark, str(tmp_path / "ck"), ["sat"], ["x"])
    assert left.schema["sat"].dataType == df.schema["sat"].dataType
    emitted = spark.read.parquet(str(tmp_path / "out"))
    fired = emitted.where(F.col(KIND) == RESULT).select("sat", "_on", "x_sum", "x_min", "x_max")
    assert sorted(map(tuple, fired.collect()), key=str) == sorted([(k, 2, 3.0, 0.0, 3.0) for k in keys], key=str)
    assert sorted((r.sat for r in left.collect()), key=str) == sorted(keys, key=str)
