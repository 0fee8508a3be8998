"""Per-record watermark semantics for out-of-order data, as set operations.

A record is late (or dead) when some record that arrived before it had already pushed
the watermark past its window. The watermark only matters at window ends, so instead
of carrying a running maximum through all records in arrival order, each window gets
two arrival positions: the first record that closes it, and the first that ends its
allowed lateness. Both come from one hash aggregation whose result has a few rows per
distinct window start. Records are then compared with their window's two positions;
they are neither sorted nor shuffled for it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import classify, is_anomaly, position, window_start
from tidemark.operators.lookup import lookup_join
from tidemark.operators.running import fitting_rows, running
from tidemark.operators.windows import (
    KEYS,
    START,
    TIME,
    channel_partials,
    partial_kinds,
    record_partials,
    to_results,
)
from tidemark.schema import CHANNELS, RULES, Rule, WindowSpec
from tidemark.session import settle

ORDER = ("ingest_seq",)
POSITION = "arrival_pos"
CLASS = "arrival_class"
ON, LATE, DEAD = "on", "late", "dead"
TOO_LATE = "past_allowed_lateness"
MISSING_TIME = "missing_event_time"
WATERMARK = "watermark_ms"
# A source's partitions are columns of the scan that merges their watermarks.
MAX_SOURCES = 512

_COMBINE = {"sum": F.sum, "min": F.min, "max": F.max}
_FIRES = "_fires_at"
_DIES = "_dies_at"


@dataclass(frozen=True)
class Closings:
    """``positions`` has a row for every window start that occurs: the position of the
    record after which the watermark had reached the window's end, and of the one after
    which the allowed lateness was over (null: never). It has at most ``starts`` rows and
    derives from a settled table. ``newest_ms`` is the largest event time, ``first`` and
    ``last`` the positions of the first and the last record, if there are any.
    """

    positions: DataFrame
    starts: int
    newest_ms: int | None
    first: int | None = None
    last: int | None = None


def closing_positions(
    df: DataFrame, spec: WindowSpec, order: Sequence[str] = ORDER, time: str = TIME
) -> Closings:
    """Find when each window start closes and when it dies, in one pass over ``df``.

    A record without a time has no window, and closes none.
    """
    ms = F.col(time)
    size = spec.size_ms
    cells = (
        df.select(ms.alias("_ms"), position(order).alias("_pos"))
        .groupBy(
            window_start(F.col("_ms"), size).alias("_own"),
            window_start(F.col("_ms") - spec.delay_ms, size).alias("_closes_below"),
            window_start(F.col("_ms") - spec.delay_ms - spec.lateness_ms, size).alias(
                "_kills_below"
            ),
        )
        .agg(
            F.min("_pos").alias("_pos"), F.max("_pos").alias("_end"), F.max("_ms").alias("max_ms")
        )
    )
    pos_type = cells.schema["_pos"].dataType
    no_pos = F.lit(None).cast(pos_type)

    def mark(start: str, fires: Column, dies: Column, occurs: int) -> Column:
        return F.struct(
            F.col(start).alias(START),
            fires.alias(_FIRES),
            dies.alias(_DIES),
            F.lit(occurs).alias("_occurs"),
        )

    marks = settle(
        cells.select(
            "max_ms",
            F.col("_pos").alias("_first"),
            "_end",
            F.inline(
                F.array(
                    mark("_own", no_pos, no_pos, 1),
                    mark("_closes_below", F.col("_pos"), no_pos, 0),
                    mark("_kills_below", no_pos, F.col("_pos"), 0),
                )
            ),
        )
        .groupBy(START)
        .agg(
            F.min(_FIRES).alias(_FIRES),
            F.min(_DIES).alias(_DIES),
            F.max("_occurs").alias("_occurs"),
            F.max("max_ms").alias("max_ms"),
            F.min("_first").alias("_first"),
            F.max("_end").alias("_end"),
        )
    )
    found = marks.agg(
        F.count(F.lit(1)).alias("starts"),
        F.max("max_ms").alias("top"),
        F.min("_first").alias("first"),
        F.max("_end").alias("last"),
    ).first()
    # A window is closed by any record whose own closing bound lies in a later window.
    positions = (
        running(
            marks.where(F.col(START).isNotNull())
            .drop("_first", "_end")
            .withColumn("_from_latest", -F.col(START)),
            [],
            "_from_latest",
            {"_first_fire": ("min", _FIRES), "_first_death": ("min", _DIES)},
            inclusive=False,
            at_most=found["starts"],
        )
        .where("_occurs = 1")
        .select(START, F.col("_first_fire").alias(_FIRES), F.col("_first_death").alias(_DIES))
    )
    ends = [None if found[end] is None else int(found[end]) for end in ("first", "last")]
    return Closings(positions, found["starts"], found["top"], *ends)


def classify_arrivals(
    df: DataFrame,
    closings: Closings,
    spec: WindowSpec,
    order: Sequence[str] = ORDER,
    time: str = TIME,
    seen_ms: int | None = None,
) -> DataFrame:
    """Add ``window_start_ms``, ``arrival_pos`` and ``arrival_class``.

    ``seen_ms`` is the largest event time of earlier batches, if there were any. A record
    without a time is dead: it belongs to no window.
    """
    placed = df.withColumns(
        {START: window_start(F.col(time), spec.size_ms), POSITION: position(order)}
    )
    late = F.coalesce(F.col(_FIRES) < F.col(POSITION), F.lit(False))
    dead = F.coalesce(F.col(_DIES) < F.col(POSITION), F.lit(False))
    if seen_ms is not None:
        end = F.col(START) + spec.size_ms
        late = late | (end <= F.lit(seen_ms - spec.delay_ms))
        dead = dead | (end <= F.lit(seen_ms - spec.delay_ms - spec.lateness_ms))
    return (
        lookup_join(
            placed, closings.positions, [START], spread=POSITION, at_most=closings.starts
        )
        .withColumn(CLASS, _class(F.col(time), dead, late))
        .drop(_FIRES, _DIES)
    )


def _class(ms: Column, dead: Column, late: Column) -> Column:
    return F.when(ms.isNull() | dead, DEAD).when(late, LATE).otherwise(ON)


def annotate_lateness(
    df: DataFrame,
    spec: WindowSpec = WindowSpec(),
    order: Sequence[str] = ORDER,
    time: str = TIME,
) -> DataFrame:
    """Tag every record ``on``, ``late`` or ``dead`` as of its own arrival.

    Calling this runs one aggregation over ``time`` and the order columns; tagging itself
    stays lazy. ``order`` must be unique, or records in the same place count as one update.
    """
    closings = closing_positions(df, spec, order, time)
    return classify_arrivals(df, closings, spec, order, time)


def watermark_before(
    df: DataFrame,
    spec: WindowSpec = WindowSpec(),
    order: Sequence[str] = ORDER,
    time: str = TIME,
    target: int | None = None,
) -> DataFrame:
    """Add ``watermark_ms``: the watermark each record met, null for the first.

    Needed only to look at the watermark itself; classification does not use it.
    """
    return (
        running(
            df.withColumn(POSITION, position(order)),
            [],
            POSITION,
            {"_seen": ("max", time)},
            inclusive=False,
            target=target,
        )
        .withColumn("watermark_ms", F.col("_seen") - spec.delay_ms)
        .drop("_seen", POSITION)
    )


@dataclass(frozen=True)
class Sources:
    """How far a source's partitions have come, and how far all of them together.

    ``reached`` has each partition's largest event time and last arrival by its name, which
    is JSON of its columns; ``top_ms`` is the merged watermark plus the delay.
    """

    reached: dict[str, tuple[int | None, int | None]]
    top_ms: int | None = None


def source_name(source: Sequence[str]) -> Column:
    """A partition's columns as one text; a null is left out of it."""
    return F.to_json(F.struct(*source))


def partition_watermarks(
    df: DataFrame,
    source: Sequence[str],
    spec: WindowSpec = WindowSpec(),
    order: Sequence[str] = ORDER,
    time: str = TIME,
    *,
    arrival: str | None = None,
    idle_ms: int | None = None,
    seen: Sources | None = None,
    target: int | None = None,
) -> tuple[DataFrame, Sources]:
    """Add the ``watermark_ms`` that each record met, merged over the source's partitions.

    A partition's watermark is its largest event time so far minus the delay; the merged one
    is the least of those of active partitions, and never moves back. A partition takes part
    from its first record with a time. With ``idle_ms`` it is left out by any record that
    arrives more than that after the partition's last one, until it has another. ``arrival``
    is the column that says when a record came, by default the first of ``order``.

    Also returns how far the partitions have come after ``df``, to go on from as ``seen``. A
    source may have ``MAX_SOURCES`` partitions, whose names the driver holds.
    """
    seen = seen or Sources({})
    arrival = arrival or order[0]
    named = df.withColumns({POSITION: position(order), "_source": source_name(source)})
    last = named.groupBy("_source").agg(
        F.max(time).alias("ms"), F.max(arrival).alias("at"), F.count(F.lit(1)).alias("n")
    )
    last = last.limit(MAX_SOURCES + 1).collect()
    found, rows = {r["_source"]: (r["ms"], r["at"]) for r in last}, sum(r["n"] for r in last)
    reached = dict(seen.reached)
    for name, new in found.items():
        pairs = zip(reached.get(name, (None, None)), new)
        reached[name] = tuple(max((v for v in pair if v is not None), default=None) for pair in pairs)
    if len(reached) > MAX_SOURCES:
        raise ValueError(f"a source of more than {MAX_SOURCES} partitions")
    if not reached:
        return named.withColumn(WATERMARK, F.lit(None).cast("long")).drop("_source", POSITION), seen
    names = sorted(reached)
    of = {f"_{i}": F.col("_source") == name for i, name in enumerate(names)}
    named = named.withColumns(
        {f"_ms{i}": F.when(own, F.col(time)) for i, own in of.items()}
        | {f"_at{i}": F.when(own, F.col(arrival)) for i, own in of.items()}
    )
    columns = [f"_{kind}_{i}" for kind in ("ms", "at") for i in range(len(names))]
    ups = {f"_up{c}": ("max", c) for c in columns}
    scanned = running(named, [], POSITION, ups, target=target, at_most=rows)

    def upto(kind: str, i: int, name: str) -> Column:
        before = seen.reached.get(name, (None, None))[kind == "at"]
        so_far = F.col(f"_up_{kind}_{i}")
        return so_far if before is None else F.greatest(so_far, F.lit(before))

    tops = []
    for i, name in enumerate(names):
        top = upto("ms", i, name)
        if idle_ms is not None:
            top = F.when(F.col(arrival) - upto("at", i, name) <= idle_ms, top)
        tops.append(top)
    merged = scanned.withColumn("_merged", F.least(*tops, F.lit(None).cast("long")))
    merged = merged.drop(*columns, *(f"_up{c}" for c in columns), "_source")
    if rows > (target or fitting_rows(merged, 1)):
        merged = settle(merged)  # dividing it reads it several times
    ups = {"_met": ("max", "_merged")}
    met = running(merged, [], POSITION, ups, inclusive=False, target=target, at_most=rows)
    top = F.col("_met") if seen.top_ms is None else F.greatest("_met", F.lit(seen.top_ms))
    after = merged.agg(F.max("_merged")).first()[0]
    known = [ms for ms in (seen.top_ms, after) if ms is not None]
    marked = met.withColumn(WATERMARK, top - spec.delay_ms).drop("_met", "_merged", POSITION)
    return marked, Sources(reached, max(known, default=None))


def classify_by_watermark(
    df: DataFrame, spec: WindowSpec, order: Sequence[str] = ORDER, time: str = TIME
) -> DataFrame:
    """Like :func:`classify_arrivals`, by the column ``watermark_ms`` that each record met."""
    end = F.col(START) + spec.size_ms
    late = F.coalesce(end <= F.col(WATERMARK), F.lit(False))
    dead = F.coalesce(end + spec.lateness_ms <= F.col(WATERMARK), F.lit(False))
    return df.withColumns(
        {START: window_start(F.col(time), spec.size_ms), POSITION: position(order)}
    ).withColumn(CLASS, _class(F.col(time), dead, late))


def dead_letters(
    annotated: DataFrame,
    spec: WindowSpec | None = None,
    time: str = TIME,
    seen_ms: int | None = None,
    target: int | None = None,
) -> DataFrame:
    """Records past the allowed lateness, raw columns kept.

    With ``spec`` also ``reason`` and ``watermark_ms``, the watermark that each met. That
    takes a running maximum over the positions and times of all records, unless the column
    is there already; their other columns don't move. ``seen_ms`` is the largest event time
    of earlier batches.
    """
    dead = annotated.where(F.col(CLASS) == DEAD)
    if spec is None:
        return dead.drop(POSITION, CLASS)
    reason = F.when(F.col(time).isNull(), MISSING_TIME).otherwise(TOO_LATE)
    if WATERMARK in annotated.columns:
        return dead.withColumn("reason", reason).drop(POSITION, CLASS)
    narrow = annotated.select(POSITION, CLASS, F.col(time).alias("_ms"))
    met = running(narrow, [], POSITION, {"_seen": ("max", "_ms")}, inclusive=False, target=target)
    met = met.where(F.col(CLASS) == DEAD).select(POSITION, "_seen")
    seen = F.col("_seen") if seen_ms is None else F.greatest("_seen", F.lit(seen_ms))
    return (
        dead.join(met, POSITION)
        .withColumns({"reason": reason, WATERMARK: seen - spec.delay_ms})
        .drop(POSITION, CLASS, "_seen")
    )


def _revision(on: Column, late: Column) -> Column:
    # A window without on-time records is created, at revision 0, by its first late one.
    return late - F.when(on == 0, 1).otherwise(0)


def windows_final(
    annotated: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    channels: Sequence[str] = CHANNELS,
    spec: WindowSpec = WindowSpec(),
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """The last emission of every window: what the sink ends up holding."""
    merged = (
        annotated.where(F.col(CLASS) != DEAD)
        .groupBy(*keys, START)
        .agg(
            F.count_if(F.col(CLASS) == ON).alias("_on"),
            F.count_if(F.col(CLASS) == LATE).alias("_late"),
            *channel_partials(annotated.schema, channels),
        )
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
        revision=_revision(on, late),
    )


def emission_groups(
    annotated: DataFrame,
    keys: Sequence[str],
    channels: Sequence[str],
    carried: DataFrame | None = None,
) -> DataFrame:
    """Accepted records reduced to the rows that can cause an emission.

    All on-time records of a window become one row; every late record stays its own
    row, because each causes an update. ``arrival_pos`` orders them, as on-time
    records of a window always precede its late ones. ``carried`` are aggregated rows of
    windows, each of which joins the on-time records of its window.
    """
    accepted = annotated.where(F.col(CLASS) != DEAD)
    late_at = F.when(F.col(CLASS) == LATE, F.col(POSITION)).alias("_late_at")
    if carried is not None:
        # Records in the form of carried rows, so that one aggregation takes both.
        on, late = ((F.col(CLASS) == c).cast("long") for c in (ON, LATE))
        partials = record_partials(annotated.schema, channels)
        rows = accepted.select(*keys, START, late_at, POSITION, on.alias("_on"), late.alias("_late"), *partials)
        return combined(rows.unionByName(carried, allowMissingColumns=True), [*keys, START, "_late_at"], channels)
    return (
        accepted.groupBy(*keys, START, late_at)
        .agg(
            F.max(POSITION).alias(POSITION),
            F.count_if(F.col(CLASS) == ON).alias("_on"),
            F.count_if(F.col(CLASS) == LATE).alias("_late"),
            *channel_partials(annotated.schema, channels),
        )
    )


def combined(rows: DataFrame, by: Sequence[str], channels: Sequence[str]) -> DataFrame:
    """Aggregated rows put together: one for each value of ``by``."""
    kinds = {POSITION: "max", "_on": "sum", "_late": "sum", **partial_kinds(channels)}
    return rows.groupBy(*by).agg(*[_COMBINE[kind](c).alias(c) for c, kind in kinds.items()])


def emissions(
    groups: DataFrame,
    *,
    keys: Sequence[str],
    channels: Sequence[str],
    spec: WindowSpec,
    rules: Sequence[Rule],
    fired: Column | None = None,
    sizes: DataFrame | None = None,
    at_most: int | None = None,
    target: int | None = None,
) -> DataFrame:
    """Every result a stream would have emitted: revision 0, then one per late record.

    ``fired`` holds for on-time rows whose window fires now; by default all do. ``at_most``
    and ``sizes`` are what :func:`running` knows them as.
    """
    kinds = {"_on": "sum", "_late": "sum", **partial_kinds(channels)}
    total = {f"_total{c}": (kind, c) for c, kind in kinds.items()}
    scanned = running(
        groups, [*keys, START], POSITION, total, target=target, at_most=at_most, sizes=sizes
    )
    emitting = F.col("_late_at").isNotNull()
    emitting = emitting | (fired if fired is not None else F.lit(True))
    merged = scanned.where(emitting).select(
        *keys, START, POSITION, *[F.col(f"_total{c}").alias(c) for c in kinds]
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
        revision=_revision(on, late),
    )


def windows_changelog(
    annotated: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    channels: Sequence[str] = CHANNELS,
    spec: WindowSpec = WindowSpec(),
    rules: Sequence[Rule] = RULES,
    target: int | None = None,
) -> DataFrame:
    # A window has as many emissions as late records, and one more.
    sizes = (
        annotated.where(F.col(CLASS) == LATE)
        .groupBy(*keys, START)
        .agg((F.count(F.lit(1)) + 1).alias("n"))
    )
    return emissions(
        emission_groups(annotated, keys, channels),
        sizes=sizes,
        keys=keys,
        channels=channels,
        spec=spec,
        rules=rules,
        target=target,
    )


def run_summary(
    annotated: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """The eight run counters in one row, from one aggregation by window."""
    accepted = F.col(CLASS) != DEAD
    needed = sorted({r.channel for r in rules})
    per_window = (
        annotated.groupBy(*keys, START)
        .agg(
            F.count_if(F.col(CLASS) == ON).alias("_on"),
            F.count_if(F.col(CLASS) == LATE).alias("_late"),
            F.count_if(F.col(CLASS) == DEAD).alias("_dead"),
            *channel_partials(annotated.schema, needed, only=accepted),
        )
        .withColumns(
            {
                f"{c}_avg": F.when(
                    F.col(f"{c}_cnt") > 0, F.col(f"{c}_sum").cast("double") / F.col(f"{c}_cnt")
                )
                for c in needed
            }
        )
        .withColumn("_has", (F.col("_on") + F.col("_late") > 0).cast("int"))
        .withColumn("_anomalous", is_anomaly(classify(rules)) * F.col("_has"))
    )

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    on, late, has = F.col("_on"), F.col("_late"), F.col("_has")
    return per_window.agg(
        total(on + late + F.col("_dead")).alias("records_in"),
        total(on).alias("on_time"),
        total(late).alias("late_accepted"),
        total(F.col("_dead")).alias("dead_lettered"),
        total(has).alias("windows_fired"),
        total(late - ((on == 0) & (late > 0)).cast("int")).alias("window_updates"),
        total(has).alias("sink_rows"),
        total(F.col("_anomalous")).alias("anomalous_windows"),
    )
