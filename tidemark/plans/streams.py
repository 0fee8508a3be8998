"""Streaming queries over the given tables, run to completion before they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import record_id
from tidemark.operators.revisions import keep_latest
from tidemark.operators.windows import START
from tidemark.plans.inputs import (
    CHANNELS,
    IDLE_MS,
    KEYS,
    ORDER,
    PARTITIONS,
    SHAPE,
    SPEC,
    Inputs,
)
from tidemark.schema import STATS
from tidemark.sources.files import replay
from tidemark.streaming.exact import ExactLateWindows, start_exact
from tidemark.streaming.native import drop_redelivered_stream, native_windows
from tidemark.streaming.redelivery import first_deliveries, seen_ranges
from tidemark.streaming.stateful import (
    DEAD,
    KIND,
    late_windows_stream,
    open_windows,
    rocksdb_state,
    window_results,
)

# Longer than any record of the tables is held back.
DEDUP_WAIT_MS = 7 * 24 * 3_600_000

RESULT_COLUMNS = [
    *KEYS,
    START,
    "window_end_ms",
    "sample_count",
    "late_count",
    "anomaly_type",
    "is_anomaly",
    "revision",
    "result_key",
    *[f"{c}_{s}" for c in CHANNELS for s in STATS],
]


def _run(writer, checkpoint: str) -> None:
    """Run a query over what has arrived.

    Its first start fixes the number of state partitions, the configured one, for good.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def _per_batch(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def exact_run(inputs: Inputs, rows: DataFrame | None = None) -> tuple[ExactLateWindows, int]:
    """Feed the slices one after another, the query restarting from its checkpoint."""
    base = inputs.scratch("exact")
    sink = ExactLateWindows(f"{base}/tables", order=ORDER, **SHAPE)
    return sink, _fed(inputs, sink, base, inputs.arrive_in_slices(f"{base}/in", rows), inputs.telemetry)


def _fed(inputs: Inputs, sink: ExactLateWindows, base: str, slices, like: DataFrame) -> int:
    """Run the query once per slice; returns the last batch that had records."""
    last = -1
    for _ in slices:
        stream = replay(inputs.spark, f"{base}/in", like.schema)
        query = start_exact(stream, sink, f"{base}/checkpoint", availableNow=True)
        query.awaitTermination()
        last = max([last, *(p["batchId"] for p in query.recentProgress if p["numInputRows"])])
    return last


def _again(inputs: Inputs, sink: ExactLateWindows) -> ExactLateWindows:
    """The whole input once more below the same path, under another query id."""
    again = ExactLateWindows(sink.path, query_id="again", order=ORDER, **SHAPE)
    again(inputs.telemetry, 0)
    again.flush(inputs.spark, 0)
    return again


def late_windows_exact(inputs: Inputs) -> DataFrame:
    sink, last = exact_run(inputs)
    sink.flush(inputs.spark, last)
    return sink.latest(inputs.spark).select(*RESULT_COLUMNS)


def late_changelog_exact(inputs: Inputs) -> DataFrame:
    sink, last = exact_run(inputs)
    sink.flush(inputs.spark, last)
    return sink.changelog(inputs.spark).select(*RESULT_COLUMNS)


def missing_time_exact(inputs: Inputs) -> DataFrame:
    """Windows of a stream in which some records have no event time."""
    sink, last = exact_run(inputs, inputs.with_missing_times)
    sink.flush(inputs.spark, last)
    return sink.latest(inputs.spark).select(*RESULT_COLUMNS)


def partitioned_run(inputs: Inputs) -> ExactLateWindows:
    """A source of three partitions, cut at other places by each batch, to its end."""
    base = inputs.scratch("partitions")
    sink = ExactLateWindows(
        f"{base}/tables",
        order=ORDER,
        source=["part"],
        idle_ms=IDLE_MS,
        expected=[(i,) for i in range(PARTITIONS)],
        explain_dead=True,
        **SHAPE,
    )
    last = _fed(inputs, sink, base, inputs.arrive_by_partition(f"{base}/in"), inputs.partitioned)
    sink.flush(inputs.spark, last)
    return sink


def partitioned_windows(inputs: Inputs) -> DataFrame:
    return partitioned_run(inputs).changelog(inputs.spark).select(*RESULT_COLUMNS)


def partitioned_dead(inputs: Inputs) -> DataFrame:
    dead = partitioned_run(inputs).dead_letters(inputs.spark)
    return dead.select("event_id", "part", "event_ts_ms", "arrival_ms", "reason", "watermark_ms")


def state_eviction(inputs: Inputs) -> DataFrame:
    """What the last batch still holds: windows whose allowed lateness is not over."""
    sink, last = exact_run(inputs)
    return sink.state(inputs.spark, last).select(
        *KEYS, START, F.col("_on").alias("on_time"), F.col("_late").alias("late_count")
    )


def fired_by_watermark(inputs: Inputs) -> DataFrame:
    """Emissions before the end of input: windows the watermark did not reach are missing."""
    sink, _ = exact_run(inputs)
    return sink.changelog(inputs.spark).select(*RESULT_COLUMNS)


def end_of_stream_flush(inputs: Inputs) -> DataFrame:
    """Only the windows that the end of input fired."""
    sink, last = exact_run(inputs)
    sink.flush(inputs.spark, last)
    flushed = sink.changelog(inputs.spark).where(F.col("batch_id") == last + 1)
    return flushed.select(*RESULT_COLUMNS)


def stream_counters(inputs: Inputs) -> DataFrame:
    """A run's counters are its own, whoever else writes to the same tables."""
    sink, last = exact_run(inputs)
    sink.flush(inputs.spark, last)
    _again(inputs, sink)
    return sink.counters(inputs.spark)


def exactly_once_effect(inputs: Inputs) -> DataFrame:
    """The same input processed under two query ids: the latest view is that of one."""
    sink, last = exact_run(inputs)
    sink.flush(inputs.spark, last)
    again = _again(inputs, sink)
    return again.latest(inputs.spark, every_query=True).select(*RESULT_COLUMNS)


def _stateful_run(inputs: Inputs, rows: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    base = inputs.scratch("stateful")
    with rocksdb_state(inputs.spark):
        for _ in inputs.arrive_in_slices(f"{base}/in", rows):
            stream = replay(inputs.spark, f"{base}/in", inputs.telemetry.schema)
            tagged = late_windows_stream(
                stream, keys=KEYS, channels=CHANNELS, spec=SPEC, spread="event_id", salts=2
            )
            writer = tagged.writeStream.outputMode("append")
            _run(writer.foreachBatch(_per_batch(f"{base}/out")), f"{base}/checkpoint")
    still_open = open_windows(inputs.spark, f"{base}/checkpoint", KEYS, CHANNELS)
    return inputs.spark.read.parquet(f"{base}/out"), still_open


def late_window_processor(inputs: Inputs) -> DataFrame:
    """Keyed-state results after a final flush; means are of doubles, hence rounded."""
    emitted, still_open = _stateful_run(inputs)
    rows = emitted.unionByName(still_open, allowMissingColumns=True)
    results = window_results(rows, **SHAPE)
    return results.withColumns({f"{c}_avg": F.round(f"{c}_avg", 6) for c in CHANNELS})


def _dead(emitted: DataFrame) -> DataFrame:
    return emitted.where(F.col(KIND) == DEAD).select("event_id", *KEYS, "event_ts_ms")


def late_window_processor_dead(inputs: Inputs) -> DataFrame:
    return _dead(_stateful_run(inputs)[0])


def late_window_processor_old(inputs: Inputs) -> DataFrame:
    """Dead letters where some records come 40 days late, and some 400."""
    return _dead(_stateful_run(inputs, inputs.with_old_records)[0])


def native_windows_final(inputs: Inputs) -> DataFrame:
    """Append mode: windows that no record can change any more.

    The slices come in arrival order; what is behind the watermark by then is not counted.
    """
    base = inputs.scratch("native")
    for _ in inputs.arrive_in_slices(f"{base}/in"):
        stream = replay(inputs.spark, f"{base}/in", inputs.telemetry.schema)
        results = native_windows(stream, **SHAPE)
        writer = results.writeStream.outputMode("append").format("parquet")
        _run(writer.option("path", f"{base}/out"), f"{base}/checkpoint")
    return inputs.spark.read.schema(results.schema).parquet(f"{base}/out")


def native_windows_update(inputs: Inputs) -> DataFrame:
    """Update mode: the newest batch's row per window counts, and some come in several."""
    base = inputs.scratch("native")
    for _ in inputs.arrive_in_slices(f"{base}/in"):
        stream = replay(inputs.spark, f"{base}/in", inputs.telemetry.schema)
        results = native_windows(stream, **SHAPE)
        writer = results.writeStream.outputMode("update").foreachBatch(_per_batch(f"{base}/out"))
        _run(writer, f"{base}/checkpoint")
    stored = inputs.spark.read.parquet(f"{base}/out")
    latest = keep_latest(stored, (*KEYS, START), revision="batch_id", seq=["sample_count"])
    return latest.select(*RESULT_COLUMNS)


def bounded_replay(inputs: Inputs) -> DataFrame:
    """The stored telemetry read as a finite stream and written out again."""
    base = inputs.scratch("replay")
    for _ in inputs.arrive_in_slices(f"{base}/in"):
        writer = replay(inputs.spark, f"{base}/in", inputs.telemetry.schema).writeStream
        _run(writer.format("parquet").option("path", f"{base}/out"), f"{base}/checkpoint")
    stored = inputs.spark.read.schema(inputs.telemetry.schema).parquet(f"{base}/out")
    return stored.select(
        "event_id", "user_id", "event_ts_ms", "arrival_ms",
        *[F.col(c).cast("double").alias(c) for c in CHANNELS],
    )


def source_dedup_stream(inputs: Inputs) -> DataFrame:
    """Every third record delivered twice, the copies dropped as they arrive."""
    base = inputs.scratch("dedup")
    copies = F.when(F.col("event_id") % 3 == 0, 2).otherwise(1)
    rows = inputs.telemetry.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
    for _ in inputs.arrive_in_slices(f"{base}/in", rows):
        stream = replay(inputs.spark, f"{base}/in", inputs.telemetry.schema)
        stream = stream.withColumn("record_id", record_id(F.col("user_id"), F.col("event_id")))
        writer = drop_redelivered_stream(stream, DEDUP_WAIT_MS).writeStream.format("parquet")
        _run(writer.option("path", f"{base}/out"), f"{base}/checkpoint")
    stored = inputs.spark.read.schema(stream.schema).parquet(f"{base}/out")
    return stored.groupBy("record_id").agg(F.count(F.lit(1)).alias("n"))


# The telemetry as that of a few senders which number their samples without a gap.
SENDERS = 8


def _first_delivery_run(inputs: Inputs) -> tuple[DataFrame, DataFrame]:
    """Every third record delivered twice more: at once, and with the last slice."""
    base = inputs.scratch("first")
    rows = inputs.telemetry.withColumns(
        {"sender": F.col("event_id") % SENDERS, "sample": F.expr(f"event_id div {SENDERS}")}
    )
    last = rows.agg(F.max("arrival_ms")).first()[0]
    own = F.array("arrival_ms")
    copies = F.when(F.col("event_id") % 3 == 0, F.array("arrival_ms", "arrival_ms", F.lit(last)))
    rows = rows.withColumn("arrival_ms", F.explode(F.coalesce(copies, own)))
    with rocksdb_state(inputs.spark):
        for _ in inputs.arrive_in_slices(f"{base}/in", rows):
            stream = replay(inputs.spark, f"{base}/in", rows.schema).select("sender", "sample")
            passed = first_deliveries(stream, "sample", ["sender"], block_numbers=1_000)
            writer = passed.writeStream.outputMode("append").format("parquet")
            _run(writer.option("path", f"{base}/out"), f"{base}/checkpoint")
    ranges = seen_ranges(inputs.spark, f"{base}/checkpoint", "sender long")
    return inputs.spark.read.schema("sender long, sample long").parquet(f"{base}/out"), ranges


def first_delivery(inputs: Inputs) -> DataFrame:
    """Each sample with the number of times that it passed."""
    passed, _ = _first_delivery_run(inputs)
    return passed.groupBy("sender", "sample").agg(F.count(F.lit(1)).alias("n"))


def first_delivery_state(inputs: Inputs) -> DataFrame:
    """What is remembered in the end: one range per sender and block of numbers."""
    return _first_delivery_run(inputs)[1]
