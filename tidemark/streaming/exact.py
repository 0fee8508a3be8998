"""Streaming windows with per-record watermarks, revisions and dead letters.

Each micro-batch runs the batch operators of :mod:`tidemark.operators.lateness`, seeded
with what earlier batches left behind: the largest event time seen and one aggregated
row per window that can still change. Batches must follow each other in arrival order;
where they are cut then has no influence on the result. A batch that reaches back before
the last position of an earlier one ends the stream with an error.

A source of several partitions has an order within each only. With ``source`` the columns
that name them, records wait until every active partition has come as far, and are then
taken in the order of their arrivals: where a batch cuts each partition has no influence
either. Every partition has a watermark of its own, and the least of them counts.

A batch exists for readers once its line in the log of commits is written, which is the
last thing that it does: tables of a batch that failed, or is being written, don't show.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.files import exists, read_text, remove
from tidemark.operators.lateness import (
    ORDER,
    POSITION,
    Sources,
    classify_arrivals,
    classify_by_watermark,
    closing_positions,
    combined,
    dead_letters,
    emission_groups,
    emissions,
    partition_watermarks,
    source_name,
)
from tidemark.operators.windows import KEYS, START, TIME
from tidemark.schema import CHANNELS, RULES, Rule, WindowSpec
from tidemark.sinks.changelog import (
    batch_path,
    commit_batch,
    commit_path,
    committed,
    commits,
    compact,
    latest_view,
    of_query,
    read_batches,
    uncommit_batch,
    write_batch,
)


@dataclass(frozen=True)
class ExactLateWindows:
    """A ``foreachBatch`` function; everything it knows is in tables below ``path``.

    Every table is written per ``query_id`` and batch, as a whole and from inputs that
    a repeated batch finds unchanged, so running a batch again has no further effect.
    ``path`` must be reachable by all executors.
    """

    path: str
    query_id: str = "main"
    keys: Sequence[str] = KEYS
    channels: Sequence[str] = CHANNELS
    spec: WindowSpec = field(default_factory=WindowSpec)
    rules: Sequence[Rule] = RULES
    order: Sequence[str] = ORDER
    time: str = TIME
    # Whether dead letters say why and which watermark they met; costs a pass per batch.
    explain_dead: bool = False
    # Columns that name a partition of the source, and the one that says when a record came,
    # which doesn't fall within a partition. The watermark leaves out a partition that is
    # silent for longer than ``idle_ms``. Records wait for partitions that are behind, for
    # those of ``expected`` from the beginning, but not for one that is more than ``wait_ms``
    # behind the newest; what it brings later is taken when it comes.
    source: Sequence[str] = ()
    arrival: str | None = None
    idle_ms: int | None = None
    wait_ms: int | None = None
    expected: Sequence[Sequence] = ()

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state, seen = self._carried(spark, batch_id)
        # From here on the batch, or a flush in its place, is not there for readers.
        uncommit_batch(spark, self.path, self.query_id, batch_id)
        came = batch.persist()
        try:
            ready, seen = self._ready(came, seen, batch_id)
            self._process(ready, state, seen, batch_id)
        finally:
            came.unpersist()
        self.forget(spark, batch_id - 1)

    def _process(self, ready: DataFrame, state: DataFrame | None, seen: dict, batch_id: int) -> None:
        """Write what the records of a batch lead to, and commit."""
        spark, seen_ms = ready.sparkSession, seen.get("ms")
        annotated, new = self._annotated(ready, seen)
        explained = (self.spec, self.time, seen_ms) if self.explain_dead else ()
        dead = dead_letters(annotated, *explained)
        if self.source and not self.explain_dead:
            dead = dead.drop("watermark_ms")
        self._write(dead, "dead_letters", batch_id)
        groups = self._with_state(annotated, state).persist()
        try:
            # Counting fills the cache for both writes, and spares the search for large
            # groups where all of them together are small.
            late = F.coalesce(F.sum(F.when(F.col("_late_at").isNotNull(), F.col("_late"))), F.lit(0))
            n, late = groups.agg(F.count(F.lit(1)), late).first()
            self._write(self._emitted(groups, seen_ms, new["ms"], n), "changelog", batch_id)
            self._write(self._kept(groups, new["ms"]), "state", batch_id)
            counted = {"late_accepted": int(late), "records_in": ready.count()}
        finally:
            groups.unpersist()
        self._commit(spark, batch_id, seen | new, counted)

    def _annotated(self, ready: DataFrame, seen: dict) -> tuple[DataFrame, dict]:
        """Records with their class, and how far the stream has come with them."""
        if self.source:
            before = Sources({k: tuple(v) for k, v in seen.get("merged", {}).items()}, seen.get("ms"))
            marked, after = partition_watermarks(
                ready,
                self.source,
                self.spec,
                self.order,
                self.time,
                arrival=self.arrival,
                idle_ms=self.idle_ms,
                seen=before,
            )
            annotated = classify_by_watermark(marked, self.spec, self.order, self.time)
            return annotated, {"ms": after.top_ms, "merged": after.reached}
        closings = closing_positions(ready, self.spec, self.order, self.time)
        last = seen.get("last")
        if closings.last is not None:
            if last is not None and closings.first <= last:
                raise ValueError(
                    f"batch begins at {closings.first}, before the end {last} of earlier ones; "
                    "batches must follow each other in arrival order"
                )
            last = closings.last
        known = [m for m in (seen.get("ms"), closings.newest_ms) if m is not None]
        annotated = classify_arrivals(
            ready, closings, self.spec, self.order, self.time, seen.get("ms")
        )
        return annotated, {"ms": max(known, default=None), "last": last}

    def _ready(self, came: DataFrame, seen: dict, batch_id: int) -> tuple[DataFrame, dict]:
        """The records whose turn it is; those that partitions hold back are kept for later."""
        if not self.source:
            return came, seen
        spark, at = came.sparkSession, F.col(self.arrival or self.order[0])
        waiting = came
        if batch_id and seen.get("waiting"):
            held = spark.read.schema(came.schema).parquet(self._at("waiting", batch_id - 1))
            waiting = held.unionByName(came)
        last = came.groupBy(source_name(self.source).alias("s")).agg(F.max(at).alias("at"), F.min(at).alias("from"))
        found = [tuple(r) for r in last.collect()]
        arrived = dict(seen.get("arrived", {}))
        for name, top, _ in found:
            arrived[name] = max(top, arrived.get(name, top))
        if not arrived:
            return came, seen
        began = min([*(low for _, _, low in found), *([seen["began"]] if "began" in seen else [])])
        newest = max(arrived.values())
        progress = {self._named(spark, e): began for e in self.expected} | arrived
        active = [p for p in progress.values() if self.wait_ms is None or newest - p <= self.wait_ms]
        # More may come that arrived with the last record of a partition.
        frontier = min(active)
        waiting.where(at >= frontier).write.mode("overwrite").parquet(self._at("waiting", batch_id))
        more = {"arrived": arrived, "began": began, "waiting": True}
        return waiting.where(at < frontier), seen | more

    def _named(self, spark: SparkSession, values: Sequence) -> str:
        one = [F.lit(v).alias(c) for c, v in zip(self.source, values, strict=True)]
        return spark.range(1).select(F.to_json(F.struct(*one))).first()[0]

    def flush(self, spark: SparkSession, last_batch_id: int) -> None:
        """End of input: take what waits, and emit the windows the watermark did not reach.

        They take the place of the next batch. If the stream goes on after all, that
        batch overwrites them and the windows fire when they are due.
        """
        if last_batch_id < 0:
            return  # nothing has come
        state, seen = self._carried(spark, last_batch_id + 1)
        batch_id, counted = last_batch_id + 1, {"late_accepted": 0, "records_in": 0}
        uncommit_batch(spark, self.path, self.query_id, batch_id)
        groups = state.withColumn("_late_at", F.lit(None).cast(state.schema[POSITION].dataType))
        now_ms = seen.get("ms")
        if seen.get("waiting"):
            ready = spark.read.parquet(self._at("waiting", last_batch_id))
            annotated, _ = self._annotated(ready, seen)
            explained = (self.spec, self.time, now_ms) if self.explain_dead else ()
            dead = dead_letters(annotated, *explained)
            self._write(dead if self.explain_dead else dead.drop("watermark_ms"), "dead_letters", batch_id)
            groups = self._with_state(annotated, state)
            late = groups.where(F.col("_late_at").isNotNull()).agg(F.coalesce(F.sum("_late"), F.lit(0)))
            counted = {"late_accepted": int(late.first()[0]), "records_in": ready.count()}
        self._write(self._emitted(groups, now_ms, None), "changelog", batch_id)
        self._commit(spark, batch_id, {"flush": True}, counted)

    def _commit(self, spark: SparkSession, batch_id: int, seen: dict, counted: dict) -> None:
        """Count what the batch wrote, from its files, and make it visible."""
        emitted = spark.read.parquet(self._at("changelog", batch_id)).agg(
            F.count_if(F.col("revision") == 0), F.count_if(F.col("revision") > 0)
        )
        fired, updates = emitted.first()
        dead = 0
        if exists(spark, self._at("dead_letters", batch_id)):
            dead = spark.read.parquet(self._at("dead_letters", batch_id)).count()
        counted = counted | {"dead_lettered": dead, "windows_fired": fired, "window_updates": updates}
        counted["on_time"] = counted["records_in"] - counted["late_accepted"] - dead
        commit_batch(spark, self.path, self.query_id, batch_id, counted, seen)

    def changelog(self, spark: SparkSession, every_query: bool = False) -> DataFrame:
        """The emissions of this query id, or of all that write below ``path``."""
        return self._read(spark, "changelog", every_query)

    def latest(self, spark: SparkSession, every_query: bool = False) -> DataFrame:
        return latest_view(self.changelog(spark, every_query), (*self.keys, START))

    def dead_letters(self, spark: SparkSession, every_query: bool = False) -> DataFrame:
        return self._read(spark, "dead_letters", every_query)

    def counters(self, spark: SparkSession) -> DataFrame:
        """Counters of this query id's run in one row, as its batches stored them."""
        log = of_query(commits(spark, self.path), self.query_id)
        names = ("records_in", "on_time", "late_accepted", "dead_lettered", "windows_fired", "window_updates")
        return log.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])

    def compact(self, spark: SparkSession, last_batch_id: int) -> int:
        """Put all batches before the last into few files; readers see the same rows."""
        return compact(spark, self.path, self.query_id, last_batch_id - 1)

    def state(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.parquet(self._at("state", batch_id))

    def forget(self, spark: SparkSession, before_batch_id: int) -> None:
        """Remove the state of earlier batches, newest first, down to a gap.

        Only the state before a batch that may still be run again is needed, so batches
        before the last two can be given up at any time.
        """
        for batch_id in range(before_batch_id - 1, -1, -1):
            if not any([remove(spark, self._at(t, batch_id)) for t in ("state", "waiting")]):
                break

    def _at(self, table: str, batch_id: int) -> str:
        return batch_path(f"{self.path}/{table}", self.query_id, batch_id)

    def _read(self, spark: SparkSession, table: str, every_query: bool) -> DataFrame:
        batches = committed(read_batches(spark, f"{self.path}/{table}"), commits(spark, self.path))
        return batches if every_query else of_query(batches, self.query_id)

    def _carried(self, spark: SparkSession, batch_id: int) -> tuple[DataFrame | None, dict]:
        after = self._seen(spark, batch_id + 1)
        if after is not None and not after.get("flush"):
            raise ValueError(
                f"{self.path} holds batches after {batch_id} of query id {self.query_id!r}; "
                "a stream that starts anew needs a path or a query id of its own"
            )
        if batch_id == 0:
            return None, {}
        seen = self._seen(spark, batch_id - 1)
        if seen is None or seen.get("flush"):
            raise ValueError(f"batch {batch_id - 1} of query id {self.query_id!r} isn't there")
        return self.state(spark, batch_id - 1), seen

    def _seen(self, spark: SparkSession, batch_id: int) -> dict | None:
        line = read_text(spark, commit_path(self.path, self.query_id, batch_id))
        return None if line is None else json.loads(json.loads(line)["seen"])

    def _write(self, df: DataFrame, table: str, batch_id: int) -> None:
        write_batch(df, f"{self.path}/{table}", self.query_id, batch_id)

    def _with_state(self, annotated: DataFrame, state: DataFrame | None) -> DataFrame:
        """Carried windows join their on-time rows: one aggregated row ahead of late ones."""
        return emission_groups(annotated, self.keys, self.channels, state)

    def _sizes(self, groups: DataFrame) -> DataFrame:
        """Windows with late records and their rows: each of these, and one for all others."""
        late = groups.where(F.col("_late_at").isNotNull())
        return late.groupBy(*self.keys, START).agg((F.count(F.lit(1)) + 1).alias("n"))

    def _emitted(
        self, groups: DataFrame, seen_ms: int | None, now_ms: int | None, rows: int | None = None
    ) -> DataFrame:
        end = F.col(START) + self.spec.size_ms
        fires = F.lit(True)
        if seen_ms is not None:
            fires = fires & (end > seen_ms - self.spec.delay_ms)
        if now_ms is not None:
            fires = fires & (end <= now_ms - self.spec.delay_ms)
        return emissions(
            groups,
            keys=self.keys,
            channels=self.channels,
            spec=self.spec,
            rules=self.rules,
            fired=fires,
            at_most=rows,
            sizes=self._sizes(groups),
        )

    def _kept(self, groups: DataFrame, now_ms: int | None) -> DataFrame:
        windows = combined(groups, [*self.keys, START], self.channels)
        if now_ms is None:
            return windows
        horizon = now_ms - self.spec.delay_ms - self.spec.lateness_ms
        return windows.where(F.col(START) + self.spec.size_ms > horizon)


def start_exact(
    stream: DataFrame, sink: ExactLateWindows, checkpoint: str, **trigger: object
):
    """Start the query; ``trigger`` is passed on, e.g. ``availableNow=True``."""
    writer = stream.writeStream.foreachBatch(partial(_apply, sink))
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _apply(sink: ExactLateWindows, batch: DataFrame, batch_id: int) -> None:
    sink(batch, batch_id)
