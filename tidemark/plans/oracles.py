"""The same queries in SQL for DuckDB, written from the semantics and not from the plans:
watermarks are running maxima over all rows, updates are running sums per window."""

from __future__ import annotations

from tidemark.plans.inputs import (
    CHANNELS,
    EVENT_TYPES,
    HOLD_STEP_MS,
    HOLD_STEPS,
    IDLE_MS,
    LINE_CHANNELS,
    LINE_RULES,
    LINE_SPEC,
    METRIC,
    MISSING_AT,
    MISSING_EVERY,
    OLD_EVERY,
    OLD_MS,
    PARTITION_LAG_MS,
    PARTITIONS,
    RULES,
    SLICES,
    SPEC,
)

S, D, L = SPEC.size_ms, SPEC.delay_ms, SPEC.lateness_ms


def _start(ms: str, size: int) -> str:
    return f"({ms} - ((({ms}) % {size}) + {size}) % {size})"


def _values(names, template: str) -> str:
    return ", ".join(template.format(c=c) for c in names)


_RAW = _values(CHANNELS, "CAST({c} AS DOUBLE) AS {c}")

EVENTS = f"""
ev AS (
  SELECT event_id, user_id, epoch_us(ts) // 1000 AS event_ts_ms,
    epoch_us(ts) // 1000 + CASE WHEN event_id % 20 = 7
      THEN (1 + (event_id * 7919) % {HOLD_STEPS}) * {HOLD_STEP_MS} ELSE 0 END AS arrival_ms,
    {", ".join(
        f"CASE WHEN event_type = '{t}' THEN CAST(value AS DECIMAL(18,2)) END AS ch_{t}"
        for t in EVENT_TYPES
    )}
  FROM events
), placed AS (SELECT *, {_start("event_ts_ms", S)} AS ws FROM ev)"""

CLASSES = (
    EVENTS
    + f""", marked AS (
  SELECT *, max(event_ts_ms) OVER (ORDER BY arrival_ms, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {D} AS wm FROM placed
), cls AS (
  SELECT *, CASE WHEN ws + {S} <= wm - {L} THEN 'dead' WHEN ws + {S} <= wm THEN 'late'
    ELSE 'on' END AS arrival_class FROM marked
)"""
)


def _label(rules) -> str:
    whens = " ".join(
        f"WHEN {r.channel}_{r.stat} {r.op} {r.value} THEN '{r.label}'" for r in rules
    )
    return f"CASE {whens} ELSE 'nominal' END"


def _stats(channels, suffix: str = "") -> str:
    return ", ".join(
        f"CAST(sum({c}){suffix} AS DOUBLE) / count({c}){suffix} AS {c}_avg, "
        f"CAST(min({c}){suffix} AS DOUBLE) AS {c}_min, "
        f"CAST(max({c}){suffix} AS DOUBLE) AS {c}_max"
        for c in channels
    )


def _results(source: str, key: str, size: int, channels, rules, avg: str = "{c}_avg") -> str:
    stats = ", ".join(f"{avg.format(c=c)} AS {c}_avg, {c}_min, {c}_max" for c in channels)
    label = _label(rules)
    return f"""SELECT {key}, CAST(ws AS BIGINT) AS window_start_ms,
  CAST(ws + {size} AS BIGINT) AS window_end_ms,
  CAST(n AS INTEGER) AS sample_count, CAST(late AS INTEGER) AS late_count,
  {label} AS anomaly_type, CASE WHEN {label} = 'nominal' THEN 0 ELSE 1 END AS is_anomaly,
  CAST(rev AS INTEGER) AS revision,
  CAST({key} AS VARCHAR) || ':' || CAST(ws AS VARCHAR) AS result_key, {stats}
FROM {source}"""


_REV = "{late} - CASE WHEN {n} = {late} THEN 1 ELSE 0 END"
_LATE = "count(*) FILTER (WHERE arrival_class = 'late')"

PLAIN = (
    EVENTS
    + f""", agg AS (SELECT user_id, ws, count(*) AS n, 0 AS late, 0 AS rev, {_stats(CHANNELS)}
  FROM placed GROUP BY user_id, ws),
plain AS ({_results("agg", "user_id", S, CHANNELS, RULES)})"""
)

FINAL = (
    CLASSES
    + f""", agg AS (SELECT user_id, ws, count(*) AS n, {_LATE} AS late,
  {_REV.format(late=_LATE, n="count(*)")} AS rev, {_stats(CHANNELS)}
  FROM cls WHERE arrival_class <> 'dead' GROUP BY user_id, ws),
fin AS ({_results("agg", "user_id", S, CHANNELS, RULES)})"""
)

_AT_END = f"(SELECT max(event_ts_ms) - {D} FROM ev)"


def _changes(fires: str = "TRUE") -> str:
    """Every emission: a window's last on-time row if it ``fires``, and each late row."""
    return (
        CLASSES
        + f""", run AS (SELECT user_id, ws, arrival_class, count(*) OVER w AS n,
  {_LATE} OVER w AS late,
  count(*) FILTER (WHERE arrival_class = 'on') OVER w AS on_so_far,
  count(*) FILTER (WHERE arrival_class = 'on') OVER (PARTITION BY user_id, ws) AS on_total,
  {_stats(CHANNELS, " OVER w")}
  FROM cls WHERE arrival_class <> 'dead'
  WINDOW w AS (PARTITION BY user_id, ws ORDER BY arrival_ms, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
emit AS (SELECT *, {_REV.format(late="late", n="n")} AS rev FROM run
  WHERE arrival_class = 'late' OR (on_so_far = on_total AND {fires})),
chg AS ({_results("emit", "user_id", S, CHANNELS, RULES)})"""
    )


CHANGES = _changes()

LINES = f"""
li AS (SELECT l_suppkey, {_start("epoch_us(l_shipdate) // 1000", LINE_SPEC.size_ms)} AS ws,
  {_values(LINE_CHANNELS, "CAST({c} AS DECIMAL(18,2)) AS {c}")} FROM lineitem),
agg AS (SELECT l_suppkey, ws, count(*) AS n, 0 AS late, 0 AS rev, {_stats(LINE_CHANNELS)}
  FROM li GROUP BY l_suppkey, ws),
lines AS ({_results("agg", "l_suppkey", LINE_SPEC.size_ms, LINE_CHANNELS, LINE_RULES)})"""

# Watermark per slice of arrivals instead of per record.
SLICED = (
    EVENTS
    + f""", bounds AS (SELECT min(arrival_ms) AS lo,
    (max(arrival_ms) - min(arrival_ms)) // {SLICES} + 1 AS step FROM ev),
cut AS (SELECT placed.*, (arrival_ms - lo) // step AS slice FROM placed, bounds),
tops AS (SELECT slice, max(event_ts_ms) AS top FROM cut GROUP BY slice),
reached AS (SELECT slice, max(top) OVER (ORDER BY slice
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {D} AS wm FROM tops),
cls AS (SELECT cut.*, CASE WHEN ws + {S} <= wm - {L} THEN 'dead' WHEN ws + {S} <= wm THEN 'late'
    ELSE 'on' END AS arrival_class FROM cut JOIN reached USING (slice)),
agg AS (SELECT user_id, ws, count(*) AS n, {_LATE} AS late,
  {_REV.format(late=_LATE, n="count(*)")} AS rev, {_stats(CHANNELS)}
  FROM cls WHERE arrival_class <> 'dead' GROUP BY user_id, ws)"""
)

# Built-in windows know no late rows, only dropped ones.
COUNTED = (
    SLICED
    + f""", plain_agg AS (SELECT user_id, ws, count(*) AS n, 0 AS late, 0 AS rev, {_stats(CHANNELS)}
  FROM cls WHERE arrival_class <> 'dead' GROUP BY user_id, ws),
counted AS ({_results("plain_agg", "user_id", S, CHANNELS, RULES)})"""
)

# Event times of some records moved back, their arrivals as they were.
_OLD = SLICED.replace(
    "epoch_us(ts) // 1000 AS event_ts_ms",
    f"""epoch_us(ts) // 1000 - CASE event_id % {OLD_EVERY} WHEN 7 THEN {OLD_MS[0]}
      WHEN {OLD_EVERY // 2} THEN {OLD_MS[1]} ELSE 0 END AS event_ts_ms""",
)



def _missing(sql: str) -> str:
    """The same over records of which some have no event time, and are dead for it."""
    return (
        sql.replace(
            "epoch_us(ts) // 1000 AS event_ts_ms",
            f"CASE WHEN event_id % {MISSING_EVERY} <> {MISSING_AT} THEN epoch_us(ts) // 1000 END AS event_ts_ms",
        )
        .replace("SELECT *, CASE WHEN ws +", "SELECT *, CASE WHEN event_ts_ms IS NULL THEN 'dead' WHEN ws +")
        .replace(
            "'past_allowed_lateness' AS reason",
            "CASE WHEN event_ts_ms IS NULL THEN 'missing_event_time' ELSE 'past_allowed_lateness' END AS reason",
        )
    )


_EACH = range(PARTITIONS)
_UPTO = "OVER (ORDER BY arrival_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _by_partition(sql: str) -> str:
    """The same with the least watermark of the partitions that aren't silent, never falling."""
    return sql.replace(
        CLASSES,
        EVENTS
        + f""", came AS (
  SELECT * REPLACE (arrival_ms + part * {PARTITION_LAG_MS} AS arrival_ms) FROM (
    SELECT *, CASE WHEN event_id % 7 = 0 THEN {PARTITIONS - 1} ELSE event_id % 2 END AS part FROM placed)
), reached AS (
  SELECT *, {", ".join(f"max(CASE WHEN part = {p} THEN event_ts_ms END) {_UPTO} AS m{p}" for p in _EACH)},
    {", ".join(f"max(CASE WHEN part = {p} THEN arrival_ms END) {_UPTO} AS a{p}" for p in _EACH)} FROM came
), least_ AS (
  SELECT *, least({", ".join(f"CASE WHEN arrival_ms - a{p} <= {IDLE_MS} THEN m{p} END" for p in _EACH)}) AS top FROM reached
), marked AS (
  SELECT *, max(top) OVER (ORDER BY arrival_ms, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {D} AS wm FROM least_
), cls AS (
  SELECT *, CASE WHEN ws + {S} <= wm - {L} THEN 'dead' WHEN ws + {S} <= wm THEN 'late'
    ELSE 'on' END AS arrival_class FROM marked
)""",
    )


OUTCOMES = (
    EVENTS
    + f""", app AS (SELECT user_id, {_start("event_ts_ms", 8 * S)} AS window_start_ms,
  CAST(event_id % 3 AS INTEGER) AS revision, event_id AS seq FROM ev),
held AS (SELECT *, max(revision) OVER (PARTITION BY user_id, window_start_ms ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held FROM app),
outc AS (SELECT user_id, window_start_ms, revision, seq,
  CASE WHEN held IS NULL OR revision > held THEN 'applied'
    WHEN revision = held THEN 'ignored_duplicate' ELSE 'ignored_stale' END AS outcome FROM held)"""
)

_COUNTS = ", ".join(
    f"CAST(count(*) FILTER (WHERE outcome = '{o}') AS BIGINT) AS {o}"
    for o in ("applied", "ignored_duplicate", "ignored_stale")
)
_KEY = "user_id, window_start_ms"
_TOP = f"""SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY {METRIC} DESC NULLS LAST, window_start_ms) AS rk FROM fin WHERE is_anomaly = 1)
  WHERE rk = 1"""
_BEST_FIRST = f"ORDER BY {METRIC} DESC NULLS LAST, window_start_ms, user_id"
_TEXT_TIME = "'%Y-%m-%d %H:%M:%S'"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()} {body}"


def _final(body: str = "SELECT * FROM fin") -> str:
    return _with(FINAL, body)


def _metric(*stats: str) -> str:
    return _final(f"SELECT {_KEY}, {', '.join(f'{c}_{s}' for c in CHANNELS for s in stats)} FROM fin")


_ACCEPTED = "arrival_class <> 'dead'"
_SUMMARY = f"""SELECT
  (SELECT count(*) FROM cls) AS records_in,
  (SELECT count(*) FROM cls WHERE arrival_class = 'on') AS on_time,
  (SELECT count(*) FROM cls WHERE arrival_class = 'late') AS late_accepted,
  (SELECT count(*) FROM cls WHERE arrival_class = 'dead') AS dead_lettered,
  (SELECT count(*) FROM fin) AS windows_fired,
  (SELECT count(*) FROM chg) - (SELECT count(*) FROM fin) AS window_updates"""

# FINAL and CHANGES share their first part; both result sets in one statement.
BOTH = CHANGES + FINAL[len(CLASSES) :]

ORACLES: dict[str, str] = {
    "decode_json": """SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n
FROM events GROUP BY 1""",
    "decode_records": _with(
        EVENTS, f"SELECT event_id, user_id, event_ts_ms, arrival_ms, {_RAW} FROM ev"
    ),
    "bounded_replay": _with(
        EVENTS, f"SELECT event_id, user_id, event_ts_ms, arrival_ms, {_RAW} FROM ev"
    ),
    "scan_windows": _final(),
    "prune_by_key": _final(
        f"SELECT * FROM fin WHERE user_id = (SELECT user_id FROM ({_TOP}) {_BEST_FIRST} LIMIT 1)"
    ),
    "keep_latest": _final(),
    "sink_outcomes": _with(OUTCOMES, "SELECT * FROM outc"),
    "sink_outcome_counts": _with(OUTCOMES, f"SELECT {_COUNTS} FROM outc"),
    "offset_fence": _with(
        OUTCOMES.replace(
            "FROM app)", "FROM app WHERE seq > (SELECT max(seq) // 2 FROM app))"
        ),
        """SELECT CAST(count(*) FILTER (WHERE outcome = 'applied') AS BIGINT) AS applied,
  CAST(count(*) FILTER (WHERE outcome = 'ignored_duplicate')
    + (SELECT count(*) FROM app WHERE seq <= (SELECT max(seq) // 2 FROM app)) AS BIGINT)
    AS ignored_duplicate,
  CAST(count(*) FILTER (WHERE outcome = 'ignored_stale') AS BIGINT) AS ignored_stale FROM outc""",
    ),
    "lake_upsert": _final(),
    "serving_upsert": _final(),
    "serving_lookup": _final("SELECT * FROM fin WHERE revision >= 1"),
    "delete_by_predicate": _final("SELECT * FROM fin WHERE is_anomaly = 0"),
    "append_table": _final(),
    "load_or_create": _final(),
    "enforce_result_schema": _final(),
    "export_sorted_json": _final(),
    "kafka_payload": _with(
        EVENTS,
        f"""SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS messages,
  min(event_ts_ms) AS first_ms, max(event_ts_ms) AS last_ms,
  CAST(max(greatest({", ".join(CHANNELS)})) AS DOUBLE) AS highest FROM ev GROUP BY user_id""",
    ),
    "dead_letter": _with(
        CLASSES,
        f"""SELECT event_id, user_id, event_ts_ms, arrival_ms, {_RAW},
  'past_allowed_lateness' AS reason, wm AS watermark_ms FROM cls WHERE arrival_class = 'dead'""",
    ),
    "event_time_extract": f"""SELECT event_id, strftime(ts, {_TEXT_TIME}) AS event_ts FROM events""",
    "key_by": "SELECT user_id, count(*) AS records FROM events GROUP BY user_id",
    "window_bounds": _with(
        EVENTS,
        f"""SELECT event_id, event_ts_ms, ws AS window_start_ms, ws + {S} AS window_end_ms
FROM placed""",
    ),
    "result_projection": _metric("avg", "min", "max"),
    "is_anomaly": _final(f"SELECT {_KEY}, is_anomaly FROM fin"),
    "result_key": _with(PLAIN, "SELECT result_key FROM plain"),
    "record_id": """SELECT event_id,
  CAST(user_id AS VARCHAR) || ':' || printf('%08d', event_id) AS record_id FROM events""",
    "classify_window": _with(PLAIN, f"SELECT {_KEY}, anomaly_type FROM plain"),
    "classify_counts": _with(
        LINES,
        """SELECT anomaly_type, count(*) AS windows, CAST(sum(is_anomaly) AS BIGINT) AS anomalous
FROM lines GROUP BY anomaly_type""",
    ),
    "detail_projection": _final(
        f"""SELECT user_id, strftime(make_timestamp(window_start_ms * 1000), {_TEXT_TIME})
  AS window_start, sample_count AS samples, late_count AS late, anomaly_type AS anomaly,
  ch_view_min AS view_min, ch_error_max AS error_max, ch_click_max AS click_max FROM fin"""
    ),
    "series_projection": _final(
        f"""SELECT strftime(make_timestamp(window_start_ms * 1000), {_TEXT_TIME}) AS time,
  {METRIC}, user_id FROM fin"""
    ),
    "anomalous_only": _final("SELECT * FROM fin WHERE is_anomaly = 1"),
    "too_late": _with(
        CLASSES,
        """SELECT event_id, user_id, event_ts_ms, ws AS window_start_ms
FROM cls WHERE arrival_class = 'dead'""",
    ),
    "is_late": _with(
        CLASSES,
        """SELECT event_id, user_id, event_ts_ms, ws AS window_start_ms
FROM cls WHERE arrival_class = 'late'""",
    ),
    "in_predicate": _with(
        CHANGES + PLAIN[len(EVENTS) :].replace("agg AS", "pagg AS").replace("FROM agg", "FROM pagg"),
        f"""SELECT * FROM plain WHERE ({_KEY}) IN
  (SELECT ({_KEY}) FROM chg WHERE revision > 0)""",
    ),
    "null_to_zero": _final(f"SELECT {_KEY}, coalesce({METRIC}, 0.0) AS m FROM fin"),
    "nan_to_null": _with(
        EVENTS,
        f"SELECT event_id, {_values(CHANNELS, 'CASE WHEN event_id % 50 <> 3 THEN CAST({c} AS DOUBLE) END AS {c}')} FROM ev",
    ),
    "json_encode": _final(
        f"""SELECT {_KEY}, '{{"user_id":' || user_id || ',"window_start_ms":' || window_start_ms
  || ',"sample_count":' || sample_count || ',"late_count":' || late_count
  || ',"anomaly_type":"' || anomaly_type || '"}}' AS value FROM fin"""
    ),
    "telemetry_windows": _with(PLAIN, "SELECT * FROM plain"),
    "nan_windows": _with(
        EVENTS
        + f""", known AS (SELECT user_id, ws,
  {_values(CHANNELS, "CASE WHEN event_id % 50 <> 3 THEN {c} END AS {c}")} FROM placed),
agg AS (SELECT user_id, ws, count(*) AS n, 0 AS late, 0 AS rev, {_stats(CHANNELS)}
  FROM known GROUP BY user_id, ws)""",
        _results("agg", "user_id", S, CHANNELS, RULES, avg="round({c}_avg, 6)"),
    ),
    "supplier_windows": _with(LINES, "SELECT * FROM lines"),
    "window_count": _final(f"SELECT {_KEY}, sample_count FROM fin"),
    "window_late_count": _final(f"SELECT {_KEY}, late_count FROM fin"),
    "window_avg": _metric("avg"),
    "window_min": _metric("min"),
    "window_max": _metric("max"),
    "run_summary": _with(
        BOTH,
        _SUMMARY
        + """, (SELECT count(*) FROM fin) AS sink_rows,
  (SELECT CAST(sum(is_anomaly) AS BIGINT) FROM fin) AS anomalous_windows""",
    ),
    "panel_totals": _final(
        """SELECT count(*) AS window_results, CAST(sum(is_anomaly) AS BIGINT) AS anomalous_windows,
  CAST(sum(late_count) AS BIGINT) AS late_records FROM fin"""
    ),
    "top_anomaly_per_key": _final(_TOP),
    "max_per_key": _final(
        f"""SELECT user_id, max(coalesce({METRIC}, 0.0)) AS m FROM fin WHERE is_anomaly = 1
GROUP BY user_id"""
    ),
    "percentiles": """SELECT round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99
FROM events""",
    "distinct_keys": _final("SELECT DISTINCT user_id FROM fin"),
    "watermark_before": _with(CLASSES, "SELECT event_id, wm AS watermark_ms FROM cls"),
    "late_classes": _with(
        CLASSES, "SELECT event_id, ws AS window_start_ms, arrival_class FROM cls"
    ),
    "late_class_counts": _with(
        CLASSES, "SELECT arrival_class, count(*) AS n FROM cls GROUP BY arrival_class"
    ),
    "windows_with_lateness": _final(),
    "revision_number": _final(f"SELECT {_KEY}, revision FROM fin"),
    "window_changelog": _with(CHANGES, "SELECT * FROM chg"),
    "fire_on_watermark": _with(CHANGES, "SELECT * FROM chg WHERE revision = 0"),
    "allowed_lateness_update": _with(CHANGES, "SELECT * FROM chg WHERE revision > 0"),
    "late_create": _with(CHANGES, "SELECT * FROM chg WHERE revision = 0 AND late_count > 0"),
    "fire_order": _with(PLAIN, "SELECT * FROM plain ORDER BY window_start_ms, user_id"),
    "export_order": _final("SELECT * FROM fin ORDER BY user_id, window_start_ms"),
    "top20_rows": _final(f"SELECT * FROM ({_TOP}) {_BEST_FIRST} LIMIT 20"),
    "top20_values": _final(
        f"""SELECT max(coalesce({METRIC}, 0.0)) AS m FROM fin WHERE is_anomaly = 1
GROUP BY user_id ORDER BY m DESC LIMIT 20"""
    ),
    "native_windows_update": _with(COUNTED, "SELECT * FROM counted"),
    "native_windows_final": _with(
        COUNTED,
        f"""SELECT * FROM counted WHERE window_end_ms <= (SELECT max(event_ts_ms) FROM ev)
  - {D + L}""",
    ),
    "late_windows_exact": _final(),
    "late_changelog_exact": _with(CHANGES, "SELECT * FROM chg"),
    "fired_by_watermark": _with(_changes(f"ws + {S} <= {_AT_END}"), "SELECT * FROM chg"),
    "state_eviction": _with(
        CLASSES,
        f"""SELECT user_id, ws AS window_start_ms,
  count(*) FILTER (WHERE arrival_class = 'on') AS on_time, {_LATE} AS late_count
FROM cls WHERE {_ACCEPTED} AND ws + {S} > {_AT_END} - {L} GROUP BY user_id, ws""",
    ),
    "end_of_stream_flush": _final(f"SELECT * FROM fin WHERE window_end_ms > {_AT_END}"),
    "stream_counters": _with(BOTH, _SUMMARY),
    "exactly_once_effect": _final(),
    "late_window_processor": _with(
        SLICED, _results("agg", "user_id", S, CHANNELS, RULES, avg="round({c}_avg, 6)")
    ),
    "late_window_processor_dead": _with(
        SLICED, "SELECT event_id, user_id, event_ts_ms FROM cls WHERE arrival_class = 'dead'"
    ),
    "late_window_processor_old": _with(
        _OLD, "SELECT event_id, user_id, event_ts_ms FROM cls WHERE arrival_class = 'dead'"
    ),
    "source_dedup": _with(PLAIN, "SELECT * FROM plain"),
    "source_dedup_stream": """SELECT CAST(user_id AS VARCHAR) || ':' || printf('%08d', event_id) AS record_id,
  1::BIGINT AS n FROM events""",
}
_FENCED = OUTCOMES.replace(
    "\nheld AS (",
    """
tops AS (SELECT seq % 3 AS part, max(seq // 3) // (seq % 3 + 2) AS top FROM app WHERE seq % 3 < 2 GROUP BY seq % 3),
ahead AS (SELECT app.* FROM app LEFT JOIN tops ON part = seq % 3 WHERE top IS NULL OR seq // 3 > top),
held AS (""",
).replace("AS held FROM app)", "AS held FROM ahead)")

ORACLES |= {
    "missing_time_summary": _missing(ORACLES["run_summary"]),
    "missing_time_windows": _missing(ORACLES["windows_with_lateness"]),
    "missing_time_dead": _missing(ORACLES["dead_letter"]),
    "missing_time_exact": _missing(ORACLES["windows_with_lateness"]),
    "partition_watermark": _with(
        _by_partition(CLASSES), "SELECT event_id, part::BIGINT AS part, wm AS watermark_ms FROM cls"
    ),
    "partitioned_windows": _with(_by_partition(CHANGES), "SELECT * FROM chg"),
    "partitioned_dead": _with(
        _by_partition(CLASSES),
        """SELECT event_id, part::BIGINT AS part, event_ts_ms, arrival_ms,
  'past_allowed_lateness' AS reason, wm AS watermark_ms FROM cls WHERE arrival_class = 'dead'""",
    ),
    "offset_fence_partitions": _with(
        _FENCED,
        """SELECT CAST(count(*) FILTER (WHERE outcome = 'applied') AS BIGINT) AS applied,
  CAST(count(*) FILTER (WHERE outcome = 'ignored_duplicate')
    + (SELECT count(*) FROM app) - (SELECT count(*) FROM ahead) AS BIGINT) AS ignored_duplicate,
  CAST(count(*) FILTER (WHERE outcome = 'ignored_stale') AS BIGINT) AS ignored_stale FROM outc""",
    ),
    "offset_commit_partitions": _with(
        OUTCOMES,
        """SELECT seq % 3 AS part, greatest(
    max(seq // 3) FILTER (WHERE seq // 3 <= (SELECT (max(seq // 3) * 2 / 3)::DOUBLE // 1 FROM app)),
    CASE WHEN seq % 3 < 2 THEN max(seq // 3) // (seq % 3 + 2) END)::BIGINT AS committed FROM app GROUP BY seq % 3""",
    ),
    "first_delivery": """SELECT event_id % 8 AS sender, event_id // 8 AS sample, 1::BIGINT AS n FROM events""",
    "first_delivery_state": """SELECT event_id % 8 AS sender, event_id // 8 // 1000 AS number_block,
  min(event_id // 8) AS low, max(event_id // 8) AS high FROM events GROUP BY ALL""",
}
