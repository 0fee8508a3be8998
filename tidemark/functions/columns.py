"""Column expressions; all of them stay inside Spark's generated code."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import NOMINAL, Rule

_SECOND_KEY_SPAN = Decimal(1 << 64)


def window_start(ms: Column, size_ms: int) -> Column:
    """Start of the epoch-aligned half-open window holding ``ms`` (floors negatives)."""
    return ms - F.pmod(ms, F.lit(size_ms).cast("long"))


def window_end(ms: Column, size_ms: int) -> Column:
    return window_start(ms, size_ms) + F.lit(size_ms).cast("long")


def event_time(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def result_key(keys: Sequence[str], window_start_col: str = "window_start_ms") -> Column:
    """Identity of a window; the revision is deliberately not part of it."""
    return F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.col(window_start_col))


def record_id(key: Column, sample: Column) -> Column:
    return F.format_string("%s:%08d", key.cast("string"), sample)


def nan_to_null(c: Column) -> Column:
    """NaN would win every ``max`` and pass every ``>`` rule in Spark; treat it as missing."""
    return F.when(~F.isnan(c), c)


def null_to_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def json_encode(columns: Iterable[str]) -> Column:
    return F.to_json(F.struct(*columns))


def is_anomaly(label: Column) -> Column:
    return (label != F.lit(NOMINAL)).cast("int")


def classify(rules: Sequence[Rule], default: str = NOMINAL) -> Column:
    """Label of the first rule that holds. A null statistic makes a rule not hold."""

    def holds(rule: Rule) -> Column:
        observed = F.col(rule.column)
        if rule.op == ">":
            return observed > F.lit(rule.value)
        if rule.op == "<":
            return observed < F.lit(rule.value)
        raise ValueError(f"unsupported comparison {rule.op!r}")

    return reduce(
        lambda rest, rule: F.when(holds(rule), F.lit(rule.label)).otherwise(rest),
        reversed(rules),
        F.lit(default),
    )


def position(order: Sequence[str]) -> Column:
    """One sortable number for a record's place in arrival order.

    ``order`` names one integer column that is unique (``ingest_seq``), or two that
    are unique together (arrival time, then an id that breaks ties). A pair becomes
    a decimal, because ``min``/``max`` over a decimal can hash-aggregate while
    ``min``/``max`` over a struct would sort every row.
    """
    if len(order) == 1:
        return F.col(order[0]).cast("long")
    if len(order) == 2:
        wide = "decimal(38,0)"
        return (
            F.col(order[0]).cast("long").cast(wide) * F.lit(_SECOND_KEY_SPAN)
            + F.col(order[1]).cast("long")
        ).cast(wide)
    raise ValueError("order takes one or two integer columns")
