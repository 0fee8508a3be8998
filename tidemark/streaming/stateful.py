"""Low-latency streaming windows with revisions and dead letters on keyed state.

Windows fire and expire by event-time timers, without waiting for their key's next
record. The watermark is Spark's, so it moves once per micro-batch; for per-record
watermarks use :mod:`tidemark.streaming.exact`.

Spark drops rows behind the declared watermark before a processor sees them, which
would lose late records and dead letters alike. The watermark is therefore declared on
times moved ahead by ``SHIFT_MS``, and waits just as long: it equals the largest event
time so far, and no record can be behind it. Records whose time is missing or outside
``0 .. LAST_MS`` don't move it and come out dead. State is cleared by the processor, so
the wait does not keep it longer.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions import event_time, window_start
from tidemark.operators.windows import KEYS, START, TIME, partial_kinds, to_results
from tidemark.schema import CHANNELS, RULES, Rule, WindowSpec
from tidemark.streaming.native import EVENT_TIME

_YEAR_MS = 365 * 24 * 3_600_000
# Moved times must be later than any watermark and still fit pandas, which ends in 2262.
SHIFT_MS = 190 * _YEAR_MS
LAST_MS = 100 * _YEAR_MS
OUTSIDE = "outside_range"  # a leading underscore would not reach pandas
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"

KIND, SALT, KEY = "kind", "salt", "key_json"
RESULT, DEAD = "result", "dead"
#: Shares of the keys; the open windows of one are a task's to hold.
SHARES = 512
_STATE = "open"
_FOLD_ROWS = 1 << 18
_COMBINE = {"sum": F.sum, "min": F.min, "max": F.max}
# Keys as JSON come back as they were.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _state_type(key_type: T.StructType) -> T.StructType:
    """A share's state: a list per property of its windows, and per channel within those of
    values. ``key_type`` is always null; its type says what the keys are in JSON of."""
    longs, doubles = T.ArrayType(T.LongType()), T.ArrayType(T.DoubleType())
    kinds = {
        "due_ms": T.LongType(),
        "key_type": key_type,
        "keys": T.ArrayType(T.StringType()),
        "starts": longs,
        "on_counts": longs,
        "late_counts": longs,
        "fired": T.ArrayType(T.BooleanType()),
        "sums": T.ArrayType(doubles),
        "counts": T.ArrayType(longs),
        "mins": T.ArrayType(doubles),
        "maxs": T.ArrayType(doubles),
    }
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


@dataclass
class _Open:
    """Windows that can still change, a row each; statistics have a column per channel."""

    keys: np.ndarray
    starts: np.ndarray
    on: np.ndarray
    late: np.ndarray
    fired: np.ndarray
    sums: np.ndarray
    counts: np.ndarray
    mins: np.ndarray
    maxs: np.ndarray
    changed: np.ndarray  # by a late record of this batch

    def __len__(self) -> int:
        return len(self.starts)

    def where(self, rows: np.ndarray) -> _Open:
        return _Open(*[part[rows] for part in vars(self).values()])


def _merged(many: Sequence[_Open]) -> _Open:
    """One row for each key and start of several lists."""
    w = _Open(*[np.concatenate(parts) for parts in zip(*[vars(m).values() for m in many])])
    if not len(w):
        return w
    key, _ = pd.factorize(w.keys)
    order = np.lexsort((w.starts, key))
    w, key = w.where(order), key[order]
    new = (key[1:] != key[:-1]) | (w.starts[1:] != w.starts[:-1])
    first = np.flatnonzero(np.append(True, new))

    def each(combine: np.ufunc, part: np.ndarray) -> np.ndarray:
        return combine.reduceat(part, first, axis=0)

    return _Open(
        w.keys[first],
        w.starts[first],
        each(np.add, w.on),
        each(np.add, w.late),
        each(np.logical_or, w.fired),
        each(np.add, w.sums),
        each(np.add, w.counts),
        each(np.minimum, w.mins),
        each(np.maximum, w.maxs),
        each(np.logical_or, w.changed),
    )


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Start keyed-state queries within this; the session's own setting comes back after."""
    before = spark.conf.get(STATE_PROVIDER, None)
    spark.conf.set(STATE_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_PROVIDER)
        else:
            spark.conf.set(STATE_PROVIDER, before)


class LateWindowProcessor(StatefulProcessor):
    """The open windows of one share of the keys, and its next deadline.

    State is read and written once per share and batch, however many keys are in it. It holds
    the windows from the watermark's lateness bound onwards, a handful per key however long
    the stream runs. Within a batch the watermark stands still, so a record's class depends
    on its window only, and all records of a window merge into one update.
    """

    def __init__(
        self,
        spec: WindowSpec,
        channels: Sequence[str],
        key_type: T.StructType,
        output: Sequence[str],
    ) -> None:
        self.spec = spec
        self.channels = list(channels)
        self.key_type = key_type
        self.output = list(output)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(_STATE, _state_type(self.key_type))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        reached = self._reached(timerValues)
        due, held = self._load()
        fired, held = self._settle(held, reached)
        came = []
        for batch in rows:
            dead = batch[OUTSIDE].to_numpy()
            if reached is not None:
                ends = batch[START].to_numpy() + self.spec.size_ms
                dead = dead | (ends <= reached - self.spec.lateness_ms)
            if dead.any():
                yield batch[dead].assign(**{KIND: DEAD}).reindex(columns=self.output)
                batch = batch[~dead]
            if len(batch):
                came.append(self._windows(batch, reached))
            if sum(map(len, came)) > _FOLD_ROWS:
                held, came = _merged([held, *came]), []
        if came:
            held = _merged([held, *came])
        self._store(due, held)
        for emitted in (fired, held.where(held.changed)):
            if len(emitted):
                yield self._results(key, emitted)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due, held = self._load()
        fired, held = self._settle(held, self._reached(timerValues))
        self._store(None if due == expiredTimerInfo.getExpiryTimeInMs() else due, held)
        if len(fired):
            yield self._results(key, fired)

    def close(self) -> None:
        pass

    def _reached(self, timer_values) -> int | None:
        spark_ms = timer_values.getCurrentWatermarkInMs()
        # Spark's watermark is the largest event time, ours trails it by the delay.
        return spark_ms - self.spec.delay_ms if spark_ms > 0 else None

    def _load(self) -> tuple[int | None, _Open]:
        due, _, keys, starts, on, late, fired, *stats = self.state.get() or (None, None, *[[]] * 9)
        n, kinds = len(starts), (np.float64, np.int64, np.float64, np.float64)
        return due, _Open(
            np.array(keys, object),
            *[np.array(part, np.int64) for part in (starts, on, late)],
            np.array(fired, bool),
            *[np.array(part, kind).reshape(-1, n).T if n else np.zeros((0, len(self.channels)), kind)
              for part, kind in zip(stats, kinds)],
            np.zeros(n, bool),
        )

    def _store(self, due: int | None, held: _Open) -> None:
        """Save the windows; set a timer unless an earlier one is already waiting."""
        if not len(held):
            self.state.clear()
            return
        deadlines = held.starts + self.spec.size_ms + np.where(held.fired, self.spec.lateness_ms, 0)
        first = int(deadlines.min()) + self.spec.delay_ms
        if due is None or first < due:
            self.handle.registerTimer(first)
            due = first
        parts = (held.keys, held.starts, held.on, held.late, held.fired)
        stats = (held.sums, held.counts, held.mins, held.maxs)
        self.state.update((due, None, *[p.tolist() for p in parts], *[p.T.tolist() for p in stats]))

    def _settle(self, held: _Open, reached: int | None) -> tuple[_Open, _Open]:
        """The windows that are due, fired, and those that are not over.

        Records of a batch come before its timers, so they call this first.
        """
        if reached is None:
            return held.where(np.zeros(len(held), bool)), held
        ends = held.starts + self.spec.size_ms
        due = ~held.fired & (ends <= reached)
        held = replace(held, fired=held.fired | due)
        return held.where(due), held.where(ends + self.spec.lateness_ms > reached)

    def _windows(self, batch: pd.DataFrame, reached: int | None) -> _Open:
        """The windows of records, all channels in one pass over their values."""
        starts = batch[START].to_numpy(np.int64)
        late = np.zeros(len(starts), bool)
        if reached is not None:
            late = starts + self.spec.size_ms <= reached
        values = batch[self.channels].to_numpy(np.float64)
        known = ~np.isnan(values)
        stats = (
            np.where(known, values, 0.0),
            known.astype(np.int64),
            np.where(known, values, np.inf),
            np.where(known, values, -np.inf),
        )
        counts = ((~late).astype(np.int64), late.astype(np.int64))
        return _merged([_Open(batch[KEY].to_numpy(object), starts, *counts, late, *stats, late)])

    def _results(self, key, windows: _Open) -> pd.DataFrame:
        columns = {KEY: windows.keys, START: windows.starts, SALT: key[0], KIND: RESULT}
        columns |= {"_on": windows.on, "_late": windows.late}
        for i, c in enumerate(self.channels):
            counts = windows.counts[:, i]
            columns[f"{c}_cnt"] = counts
            for part in ("sum", "min", "max"):
                values = getattr(windows, f"{part}s")[:, i]
                columns[f"{c}_{part}"] = np.where(counts > 0, values, np.nan)
        return pd.DataFrame({c: columns.get(c) for c in self.output})


def late_windows_stream(
    df: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    channels: Sequence[str] = CHANNELS,
    spec: WindowSpec = WindowSpec(),
    time: str = TIME,
    spread: str | None = None,
    salts: int = 1,
    shares: int = SHARES,
) -> DataFrame:
    """Rows of kind ``result`` (a window's partial statistics so far) and ``dead`` (raw).

    The keys are dealt into ``shares``, whose windows are worked on together: choose as many
    that the open windows of one fit a task, and keep to it for a checkpoint. Where one key
    may take a large share of a micro-batch, ``salts`` > 1 divides it by a hash of column
    ``spread``; the parts fire by the same watermark and :func:`window_results` puts them
    together. Use append mode, and start the query within :func:`rocksdb_state`.
    """
    part = F.lit(0) if salts == 1 else F.pmod(F.xxhash64(spread or time), F.lit(salts))
    salt = F.pmod(F.xxhash64(*keys, part), F.lit(shares))
    inside = F.coalesce(F.col(time).between(0, LAST_MS), F.lit(False))
    moved = event_time(F.when(inside, F.col(time)).otherwise(0) + SHIFT_MS)
    placed = (
        df.withColumns({EVENT_TIME: moved, OUTSIDE: ~inside, KEY: F.to_json(F.struct(*keys), _JSON)})
        .withWatermark(EVENT_TIME, f"{SHIFT_MS} milliseconds")
        .withColumns({c: F.col(c).cast("double") for c in channels})
        .withColumns({START: window_start(F.col(time), spec.size_ms), SALT: salt.cast("int")})
    )
    fields = [T.StructField(f.name, f.dataType) for f in placed.schema if f.name not in (EVENT_TIME, OUTSIDE)]
    fields += [T.StructField(n, T.LongType()) for n in ("_on", "_late")]
    for c, kind in partial_kinds(channels).items():
        counted = c.endswith("_cnt") and kind == "sum"
        fields.append(T.StructField(c, T.LongType() if counted else T.DoubleType()))
    fields.append(T.StructField(KIND, T.StringType()))
    schema = T.StructType(fields)
    key_type = T.StructType([T.StructField(k, placed.schema[k].dataType) for k in keys])
    processor = LateWindowProcessor(spec, channels, key_type, schema.names)
    out = placed.groupBy(SALT).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime",
    )
    of_window = F.from_json(KEY, key_type, _JSON)
    is_result = F.col(KIND) == RESULT
    return out.withColumns(
        {k: F.when(is_result, of_window[k]).otherwise(F.col(k)) for k in keys}
    ).drop(KEY)


def window_results(
    emitted: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    channels: Sequence[str] = CHANNELS,
    spec: WindowSpec = WindowSpec(),
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """Current result per window from stored ``result`` rows of any number of batches.

    A part's counts only grow, so its newest row is the one with the highest counts.
    """
    newest = Window.partitionBy(*keys, START, SALT).orderBy((F.col("_on") + F.col("_late")).desc())
    kinds = {"_on": "sum", "_late": "sum", **partial_kinds(channels)}
    merged = (
        emitted.where(F.col(KIND) == RESULT)
        .withColumn("_rank", F.row_number().over(newest))
        .where("_rank = 1")
        .groupBy(*keys, START)
        .agg(*[_COMBINE[kind](c).alias(c) for c, kind in kinds.items()])
    )
    on, late = F.col("_on"), F.col("_late")
    return to_results(
        merged,
        keys=keys,
        channels=channels,
        spec=spec,
        rules=rules,
        count=on + late,
        late=late,
        revision=late - F.when(on == 0, 1).otherwise(0),
    )


def open_windows(
    spark: SparkSession,
    checkpoint: str,
    keys: Sequence[str] = KEYS,
    channels: Sequence[str] = CHANNELS,
) -> DataFrame:
    """Windows still unfired in a stopped query's state, as ``result`` rows.

    Appended to the emitted rows they end the input: every record is then accounted for.
    """
    stored = spark.read.format("statestore").option("stateVarName", _STATE).load(checkpoint)
    key_type = stored.schema["value"].dataType["key_type"].dataType
    lists = {KEY: "keys", START: "starts", "_on": "on_counts", "_late": "late_counts", "_fired": "fired"}
    lists = {name: F.col(f"value.{held}") for name, held in lists.items()}
    parts = {"sum": "sums", "cnt": "counts", "min": "mins", "max": "maxs"}
    for i, c in enumerate(channels):
        lists |= {f"{c}_{part}": F.col(f"value.{held}")[i] for part, held in parts.items()}
    windows = (
        stored.select(F.col(f"key.{SALT}").alias(SALT), *[v.alias(name) for name, v in lists.items()])
        .select(SALT, F.inline(F.arrays_zip(*lists)))
        .where(~F.col("_fired"))
        .withColumn("_key", F.from_json(KEY, key_type, _JSON))
    )
    known = {
        f"{c}_{part}": F.when(F.col(f"{c}_cnt") > 0, F.col(f"{c}_{part}"))
        for c in channels
        for part in ("sum", "min", "max")
    }
    return windows.withColumns(known).select(
        *[F.col("_key")[k].alias(k) for k in keys],
        SALT,
        START,
        F.lit(RESULT).alias(KIND),
        "_on",
        "_late",
        *[f"{c}_{part}" for c in channels for part in parts],
    )
