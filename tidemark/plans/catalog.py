"""Every operator as a query over the given tables: name -> (Inputs -> DataFrame)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import (
    classify,
    event_time,
    is_anomaly,
    json_encode,
    nan_to_null,
    null_to_zero,
    record_id,
    result_key,
    window_end,
    window_start,
)
from tidemark.operators import report
from tidemark.operators.lateness import (
    CLASS,
    DEAD,
    LATE,
    annotate_lateness,
    dead_letters,
    partition_watermarks,
    run_summary,
    watermark_before,
    windows_final,
)
from tidemark.operators.revisions import (
    advance_offsets,
    distinct_keys,
    drop_redelivered,
    fenced_outcomes,
    fenced_outcomes_by,
    having_keys,
    keep_latest,
    outcome_counts,
    sink_outcomes,
    without_keys,
)
from tidemark.operators.windows import START, telemetry_windows
from tidemark.plans import streams
from tidemark.plans.inputs import (
    CHANNELS,
    IDLE_MS,
    KEYS,
    LINE_SHAPE,
    METRIC,
    ORDER,
    RULES,
    SHAPE,
    SPEC,
    Inputs,
)
from tidemark.sinks import lake, serving
from tidemark.sources.kafka import decode_json, kafka_payload

NATURAL_KEY = (*KEYS, START)
# A bucket of a serving table is compared, sorted and folded in by one task.
SERVING_BUCKET_ROWS = 500_000
_TEXT_TIME = "yyyy-MM-dd HH:mm:ss"

Query = Callable[[Inputs], DataFrame]


def _raw(df: DataFrame, *more: str) -> DataFrame:
    """Telemetry columns with plain double channels."""
    return df.select(
        "event_id", "user_id", "event_ts_ms", "arrival_ms",
        *[F.col(c).cast("double").alias(c) for c in CHANNELS],
        *more,
    )


def _with_nan(x: Inputs) -> DataFrame:
    """Double channels in which one record in fifty reads NaN."""
    odd = F.col("event_id") % 50 == 3
    return _raw(x.telemetry).withColumns(
        {c: F.when(odd & F.col(c).isNotNull(), float("nan")).otherwise(F.col(c)) for c in CHANNELS}
    )


def nan_windows(x: Inputs) -> DataFrame:
    """Windows over readings of which some are NaN; means are of doubles, hence rounded."""
    found = telemetry_windows(_with_nan(x), **SHAPE)
    return found.withColumns({f"{c}_avg": F.round(f"{c}_avg", 6) for c in CHANNELS})


# Sources and sinks


def decode_props(x: Inputs) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.LongType())])
    events = x.table("events")
    return decode_json(events.withColumn("value", F.col("props")), schema).groupBy("k").agg(
        F.count(F.lit(1)).alias("n")
    )


def decode_records(x: Inputs) -> DataFrame:
    """Records encoded as messages and decoded again."""
    plain = _raw(x.telemetry)
    return decode_json(kafka_payload(plain, "user_id"), plain.schema)


def broker_messages(x: Inputs) -> DataFrame:
    """Message keys with the number of messages and what their values hold."""
    plain = _raw(x.telemetry)
    parsed = F.from_json("value", plain.schema)
    return (
        kafka_payload(plain, "user_id")
        .select("key", parsed.alias("r"))
        .groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.min("r.event_ts_ms").alias("first_ms"),
            F.max("r.event_ts_ms").alias("last_ms"),
            F.max(F.greatest(*[f"r.{c}" for c in CHANNELS])).alias("highest"),
        )
    )


def _bucketed_schema(x: Inputs) -> T.StructType:
    return T.StructType([*x.schema.fields, T.StructField(lake.BUCKET, T.IntegerType())])


def _serving_schema(x: Inputs) -> T.StructType:
    return T.StructType([*_bucketed_schema(x).fields, T.StructField(lake.DAY, T.IntegerType())])


def scan_windows(x: Inputs) -> DataFrame:
    path = x.scratch("windows")
    lake.append(lake.bucketed(x.final, 16, KEYS), path, [lake.BUCKET])
    return lake.scan(x.spark, path, x.schema)


def append_table(x: Inputs) -> DataFrame:
    path = x.scratch("windows")
    for flag in (0, 1):
        part = x.final.where(F.col("is_anomaly") == flag)
        lake.append(lake.bucketed(part, 16, KEYS), path, [lake.BUCKET])
    return lake.scan(x.spark, path, x.schema)


def prune_by_key(x: Inputs) -> DataFrame:
    """Drilldown to the key with the worst anomaly; only its bucket's folder is read."""
    path = x.scratch("windows")
    lake.append(lake.bucketed(x.final, 16, KEYS), path, [lake.BUCKET])
    table = lake.scan(x.spark, path, _bucketed_schema(x))
    worst = report.top_anomalies(table, KEYS, METRIC, n=1).first()["user_id"]
    here = lake.bucket_of(16, F.lit(worst).cast("long"))
    bucket = x.spark.range(1).select(here.alias("b")).first()["b"]
    return report.for_key(table, **{lake.BUCKET: bucket, "user_id": worst}).drop(lake.BUCKET)


def load_or_create(x: Inputs) -> DataFrame:
    name = f"windows_{uuid.uuid4().hex}"
    where = x.scratch("table")
    stored = _bucketed_schema(x)
    for _ in range(2):  # the second call finds the table
        lake.ensure_table(x.spark, name, stored, partition_by=[lake.BUCKET], location=where)
    rows = lake.enforce_schema(lake.bucketed(x.final, 16, KEYS), stored)
    rows.hint("rebalance", lake.BUCKET).write.insertInto(name)
    x.spark.sql(f"DROP TABLE {name}")  # of the catalog; the files stay where they are
    return lake.scan(x.spark, where, x.schema)


def lake_upsert(x: Inputs) -> DataFrame:
    """First emissions, then all of them, then the first ones again."""
    path, log = x.scratch("serving"), x.scratch("changelog")
    x.changelog.write.parquet(log)
    stored = x.spark.read.schema(x.changelog.schema).parquet(log)
    first = stored.where(F.col("revision") == 0)
    for batch in (first, stored, first):
        lake.upsert(
            lake.laid_out(batch, 2, KEYS),
            path,
            _serving_schema(x),
            keys=NATURAL_KEY,
            partition_by=[lake.DAY, lake.BUCKET],
        )
    return lake.scan(x.spark, path, x.schema)


def _serving_table(x: Inputs, batches, rows: int) -> str:
    """A table of as many buckets as ``rows``, the most that a batch has, need."""
    name, buckets = f"serving_{uuid.uuid4().hex}", max(2, -(-rows // SERVING_BUCKET_ROWS))
    serving.ensure(x.spark, name, x.schema, x.scratch("serving"), buckets=buckets, keys=NATURAL_KEY)
    for batch in batches:
        serving.upsert(batch, name)
    return name


def serving_upsert(x: Inputs) -> DataFrame:
    """As ``lake_upsert``, into buckets: stored rows are neither exchanged nor read twice."""
    log = x.scratch("changelog")
    x.changelog.write.parquet(log)
    stored = x.spark.read.schema(x.changelog.schema).parquet(log)
    first = stored.where(F.col("revision") == 0)
    return x.spark.table(_serving_table(x, (first, stored, first), stored.count())).select(*x.schema.names)


def serving_lookup(x: Inputs) -> DataFrame:
    """The windows that were emitted again, looked up in the serving table by their keys."""
    again = x.changelog.where(F.col("revision") >= 1).select(*NATURAL_KEY)
    return serving.lookup(again, _serving_table(x, (x.final,), x.final.count())).select(*x.schema.names)


def export_sorted_json(x: Inputs) -> DataFrame:
    path = x.scratch("export")
    lake.export_json(x.final, path, KEYS)
    return x.spark.read.schema(x.schema).json(path)


def keep_latest_replayed(x: Inputs) -> DataFrame:
    """The changelog delivered twice still gives one row per window."""
    twice = x.changelog.withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2))))
    return keep_latest(twice, NATURAL_KEY).drop("seq")


def _applied_rows(x: Inputs) -> DataFrame:
    """Sink input in event order, with revisions that rise, repeat and fall back."""
    return x.telemetry.select(
        "user_id",
        window_start(F.col("event_ts_ms"), 8 * SPEC.size_ms).alias(START),
        (F.col("event_id") % 3).cast("int").alias("revision"),
        F.col("event_id").alias("seq"),
    )


def sink_outcome_rows(x: Inputs) -> DataFrame:
    return sink_outcomes(_applied_rows(x), NATURAL_KEY)


def sink_outcome_counts(x: Inputs) -> DataFrame:
    return outcome_counts(sink_outcome_rows(x))


def offset_fence(x: Inputs) -> DataFrame:
    """Half of the offsets were committed before; they count as duplicates."""
    rows = _applied_rows(x)
    committed = rows.agg(F.max("seq")).first()[0] // 2
    return outcome_counts(fenced_outcomes(rows, "seq", committed, NATURAL_KEY))


def _by_partition(x: Inputs) -> tuple[DataFrame, DataFrame]:
    """Sink input by three partitions, and fences of two of them."""
    rows = _applied_rows(x).withColumns(
        {"part": F.col("seq") % 3, "at": F.expr("seq div 3")}
    )
    top = rows.where("part < 2").groupBy("part").agg(F.max("at").alias("top"))
    return rows, top.select("part", F.expr("top div (part + 2)").alias("committed"))


def offset_fence_partitions(x: Inputs) -> DataFrame:
    """What each partition had committed counts as duplicates; of the third, nothing had been."""
    rows, offsets = _by_partition(x)
    return outcome_counts(fenced_outcomes_by(rows, offsets, ["part"], "at", NATURAL_KEY))


def offset_commit_partitions(x: Inputs) -> DataFrame:
    """Fences after the first two thirds were committed, the first third twice."""
    rows, offsets = _by_partition(x)
    for share in (1, 2, 1):
        upto = rows.agg((F.max("at") * share / 3).cast("long")).first()[0]
        offsets = advance_offsets(offsets, rows.where(F.col("at") <= upto), ["part"], "at")
    return offsets


# Projections, predicates, scalar functions


def window_bounds(x: Inputs) -> DataFrame:
    ms = F.col("event_ts_ms")
    return x.telemetry.select(
        "event_id",
        "event_ts_ms",
        window_start(ms, SPEC.size_ms).alias("window_start_ms"),
        window_end(ms, SPEC.size_ms).alias("window_end_ms"),
    )


def classify_records(x: Inputs) -> DataFrame:
    """The rule list applied to windows of lineitem, counted by label."""
    labelled = telemetry_windows(x.lines, **LINE_SHAPE)
    return labelled.groupBy("anomaly_type").agg(
        F.count(F.lit(1)).alias("windows"), F.sum("is_anomaly").alias("anomalous")
    )


def series_projection(x: Inputs) -> DataFrame:
    series = report.panel_series(x.final, KEYS, METRIC)
    return series.withColumn("time", F.date_format("time", _TEXT_TIME))


def detail_projection(x: Inputs) -> DataFrame:
    headings = {"ch_view_min": "view_min", "ch_error_max": "error_max", "ch_click_max": "click_max"}
    detail = report.panel_detail(x.final, KEYS, headings)
    return detail.withColumn("window_start", F.date_format("window_start", _TEXT_TIME))


def json_encode_rows(x: Inputs) -> DataFrame:
    """Encoded without numbers that engines print differently."""
    return x.final.select(
        *NATURAL_KEY,
        json_encode([*NATURAL_KEY, "sample_count", "late_count", "anomaly_type"]).alias("value"),
    )


def _metric(x: Inputs, *stats: str) -> DataFrame:
    return x.final.select(*NATURAL_KEY, *[f"{c}_{s}" for c in CHANNELS for s in stats])


def _of_class(x: Inputs, name: str) -> DataFrame:
    return x.annotated.where(F.col(CLASS) == name).select("event_id", "user_id", "event_ts_ms", START)


# Windows with state and time


def redelivered(x: Inputs) -> DataFrame:
    """Every third record delivered twice, dropped by id, then aggregated."""
    copies = F.when(F.col("event_id") % 3 == 0, 2).otherwise(1)
    rows = (
        x.telemetry.withColumn("record_id", record_id(F.col("user_id"), F.col("event_id")))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        .drop("copy")
    )
    return telemetry_windows(drop_redelivered(rows), **SHAPE)


def _missing(x: Inputs) -> DataFrame:
    """Records of which some have no event time, with their classes."""
    return annotate_lateness(x.with_missing_times, SPEC, ORDER)


def partition_watermark(x: Inputs) -> DataFrame:
    """The watermark that each record met, merged over three partitions."""
    marked, _ = partition_watermarks(x.partitioned, ["part"], SPEC, ORDER, idle_ms=IDLE_MS)
    return marked.select("event_id", "part", "watermark_ms")


def lateness_counts(x: Inputs) -> DataFrame:
    return x.annotated.groupBy(CLASS).agg(F.count(F.lit(1)).alias("n"))


CATALOG: dict[str, Query] = {
    # sources and scans
    "decode_json": decode_props,
    "decode_records": decode_records,
    "bounded_replay": streams.bounded_replay,
    "scan_windows": scan_windows,
    "prune_by_key": prune_by_key,
    # sinks
    "keep_latest": keep_latest_replayed,
    "sink_outcomes": sink_outcome_rows,
    "sink_outcome_counts": sink_outcome_counts,
    "offset_fence": offset_fence,
    "offset_fence_partitions": offset_fence_partitions,
    "offset_commit_partitions": offset_commit_partitions,
    "lake_upsert": lake_upsert,
    "serving_upsert": serving_upsert,
    "serving_lookup": serving_lookup,
    "delete_by_predicate": lambda x: without_keys(
        x.final, report.anomalous_only(x.final), NATURAL_KEY
    ),
    "append_table": append_table,
    "load_or_create": load_or_create,
    "enforce_result_schema": lambda x: lake.enforce_schema(x.final, x.schema),
    "export_sorted_json": export_sorted_json,
    "kafka_payload": broker_messages,
    "dead_letter": lambda x: _raw(dead_letters(x.annotated, SPEC), "reason", "watermark_ms"),
    # projections, predicates, scalar functions
    "event_time_extract": lambda x: x.telemetry.select(
        "event_id", F.date_format(event_time(F.col("event_ts_ms")), _TEXT_TIME).alias("event_ts")
    ),
    "key_by": lambda x: x.telemetry.groupBy("user_id").agg(F.count(F.lit(1)).alias("records")),
    "window_bounds": window_bounds,
    "result_projection": lambda x: _metric(x, "avg", "min", "max"),
    "is_anomaly": lambda x: x.final.select(
        *NATURAL_KEY, is_anomaly(F.col("anomaly_type")).alias("is_anomaly")
    ),
    "result_key": lambda x: x.windows.select(result_key(KEYS).alias("result_key")),
    "record_id": lambda x: x.telemetry.select(
        "event_id", record_id(F.col("user_id"), F.col("event_id")).alias("record_id")
    ),
    "classify_window": lambda x: x.windows.select(
        *NATURAL_KEY, classify(RULES).alias("anomaly_type")
    ),
    "classify_counts": classify_records,
    "detail_projection": detail_projection,
    "series_projection": series_projection,
    "anomalous_only": lambda x: report.anomalous_only(x.final),
    "too_late": lambda x: _of_class(x, DEAD),
    "is_late": lambda x: _of_class(x, LATE),
    "in_predicate": lambda x: having_keys(
        x.windows, x.changelog.where(F.col("revision") > 0), NATURAL_KEY
    ),
    "null_to_zero": lambda x: x.final.select(
        *NATURAL_KEY, null_to_zero(F.col(METRIC)).alias("m")
    ),
    "nan_to_null": lambda x: _with_nan(x).select(
        "event_id", *[nan_to_null(F.col(c)).alias(c) for c in CHANNELS]
    ),
    "json_encode": json_encode_rows,
    # aggregations
    "telemetry_windows": lambda x: x.windows,
    "nan_windows": nan_windows,
    "supplier_windows": lambda x: telemetry_windows(x.lines, **LINE_SHAPE),
    "window_count": lambda x: x.final.select(*NATURAL_KEY, "sample_count"),
    "window_late_count": lambda x: x.final.select(*NATURAL_KEY, "late_count"),
    "window_avg": lambda x: _metric(x, "avg"),
    "window_min": lambda x: _metric(x, "min"),
    "window_max": lambda x: _metric(x, "max"),
    "run_summary": lambda x: run_summary(x.annotated, keys=KEYS, rules=RULES),
    "panel_totals": lambda x: report.panel_totals(x.final),
    "top_anomaly_per_key": lambda x: report.top_anomaly_per_key(x.final, KEYS, METRIC),
    "max_per_key": lambda x: report.max_per_key(x.final, KEYS, METRIC),
    "percentiles": lambda x: report.percentiles(
        x.table("events"), "value", {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    ).select(*[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")]),
    "distinct_keys": lambda x: distinct_keys(x.final, *KEYS),
    # running state
    "watermark_before": lambda x: watermark_before(x.telemetry, SPEC, ORDER).select(
        "event_id", "watermark_ms"
    ),
    "partition_watermark": partition_watermark,
    "missing_time_summary": lambda x: run_summary(_missing(x), keys=KEYS, rules=RULES),
    "missing_time_windows": lambda x: windows_final(_missing(x), **SHAPE),
    "missing_time_dead": lambda x: _raw(
        dead_letters(_missing(x), SPEC), "reason", "watermark_ms"
    ),
    "late_classes": lambda x: x.annotated.select("event_id", START, CLASS),
    "late_class_counts": lateness_counts,
    "windows_with_lateness": lambda x: x.final,
    "revision_number": lambda x: x.final.select(*NATURAL_KEY, "revision"),
    "window_changelog": lambda x: x.changelog,
    "fire_on_watermark": lambda x: x.changelog.where(F.col("revision") == 0),
    "allowed_lateness_update": lambda x: x.changelog.where(F.col("revision") > 0),
    "late_create": lambda x: x.changelog.where(
        (F.col("revision") == 0) & (F.col("late_count") > 0)
    ),
    # sorts and limits
    "fire_order": lambda x: report.fire_order(x.windows, KEYS),
    "export_order": lambda x: report.export_order(x.final, KEYS),
    "top20_rows": lambda x: report.top_anomalies(x.final, KEYS, METRIC),
    "top20_values": lambda x: report.top_values(x.final, KEYS, METRIC),
    # streaming
    "native_windows_update": streams.native_windows_update,
    "native_windows_final": streams.native_windows_final,
    "late_windows_exact": streams.late_windows_exact,
    "late_changelog_exact": streams.late_changelog_exact,
    "fired_by_watermark": streams.fired_by_watermark,
    "missing_time_exact": streams.missing_time_exact,
    "partitioned_windows": streams.partitioned_windows,
    "partitioned_dead": streams.partitioned_dead,
    "state_eviction": streams.state_eviction,
    "end_of_stream_flush": streams.end_of_stream_flush,
    "stream_counters": streams.stream_counters,
    "exactly_once_effect": streams.exactly_once_effect,
    "late_window_processor": streams.late_window_processor,
    "late_window_processor_dead": streams.late_window_processor_dead,
    "late_window_processor_old": streams.late_window_processor_old,
    "source_dedup": redelivered,
    "source_dedup_stream": streams.source_dedup_stream,
    "first_delivery": streams.first_delivery,
    "first_delivery_state": streams.first_delivery_state,
}
