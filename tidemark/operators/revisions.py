"""Idempotent application of window results: highest revision wins, replays change nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_join
from tidemark.operators.running import running
from tidemark.operators.windows import KEYS, START
from tidemark.session import settle

NATURAL_KEY = (*KEYS, START)
REVISION = "revision"
COMMITTED = "committed"
APPLIED, DUPLICATE, STALE = "applied", "ignored_duplicate", "ignored_stale"


def keep_latest(
    df: DataFrame,
    keys: Sequence[str] = NATURAL_KEY,
    revision: str = REVISION,
    seq: Sequence[str] = ("seq",),
) -> DataFrame:
    """One row per natural key: the highest revision, the first of equal ones by ``seq``.

    Spark applies ``row_number() = 1`` within each task before the exchange too, so
    many copies of one key shrink to one row per task.
    """
    best = Window.partitionBy(*keys).orderBy(F.col(revision).desc(), *seq)
    return df.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")


def sink_outcomes(
    df: DataFrame,
    keys: Sequence[str] = NATURAL_KEY,
    revision: str = REVISION,
    seq: str = "seq",
    target: int | None = None,
) -> DataFrame:
    """Add ``outcome``: what applying each row in ``seq`` order would have done."""
    held, new = F.col("_held"), F.col(revision)
    return (
        running(df, keys, seq, {"_held": ("max", revision)}, inclusive=False, target=target)
        .withColumn(
            "outcome",
            F.when(held.isNull() | (new > held), APPLIED)
            .when(new == held, DUPLICATE)
            .otherwise(STALE),
        )
        .drop("_held")
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        *[F.count_if(F.col("outcome") == o).alias(o) for o in (APPLIED, DUPLICATE, STALE)]
    )


def past_fence(offset: str, committed: int) -> Column:
    return F.col(offset) > F.lit(committed)


def fence(df: DataFrame, offset: str, committed: int) -> DataFrame:
    """Rows not yet durably committed."""
    return df.where(past_fence(offset, committed))


def fenced_outcomes(
    df: DataFrame,
    offset: str,
    committed: int,
    keys: Sequence[str] = NATURAL_KEY,
    revision: str = REVISION,
    target: int | None = None,
) -> DataFrame:
    """Like :func:`sink_outcomes`, with rows behind the fence counted as duplicates."""
    behind = df.where(~past_fence(offset, committed)).withColumn("outcome", F.lit(DUPLICATE))
    ahead = sink_outcomes(fence(df, offset, committed), keys, revision, offset, target)
    return ahead.unionByName(behind)


def committed_offset(df: DataFrame, offset: str, committed: int = -1) -> int:
    """The fence after ``df`` is durable; it never moves back."""
    top = df.agg(F.max(offset)).first()[0]
    return committed if top is None else max(committed, top)


def _fenced(df: DataFrame, offsets: DataFrame, source: Sequence[str], offset: str) -> DataFrame:
    """``df`` with ``_ahead``: whether a row is past its partition's committed offset."""
    held = settle(offsets.select(*source, F.col(COMMITTED).alias("_committed")))
    joined = lookup_join(df, held, source, spread=offset)
    ahead = F.col("_committed").isNull() | (F.col(offset) > F.col("_committed"))
    return joined.withColumn("_ahead", ahead).drop("_committed")


def fence_by(df: DataFrame, offsets: DataFrame, source: Sequence[str], offset: str) -> DataFrame:
    """Rows not yet durably committed, where each partition of a source has its own fence.

    ``offsets`` has the columns ``source`` that name a partition, and ``committed``. All rows
    of a partition that isn't there are ahead of it. A row without an offset is behind every
    fence, and ahead where there is none.
    """
    return _fenced(df, offsets, source, offset).where("_ahead").drop("_ahead")


def fenced_outcomes_by(
    df: DataFrame,
    offsets: DataFrame,
    source: Sequence[str],
    offset: str,
    keys: Sequence[str] = NATURAL_KEY,
    revision: str = REVISION,
    seq: str = "seq",
    target: int | None = None,
) -> DataFrame:
    """Like :func:`fenced_outcomes`, with a fence per partition and applied in ``seq`` order."""
    marked = _fenced(df, offsets, source, offset)
    behind = marked.where(~F.coalesce("_ahead", F.lit(False))).drop("_ahead")
    ahead = sink_outcomes(marked.where("_ahead").drop("_ahead"), keys, revision, seq, target)
    return ahead.unionByName(behind.withColumn("outcome", F.lit(DUPLICATE)))


def advance_offsets(
    offsets: DataFrame, df: DataFrame, source: Sequence[str], offset: str
) -> DataFrame:
    """The fences after ``df`` is durable: a merge that never moves one back.

    Merging the same rows again changes nothing, and partitions may be new.
    """
    come = df.select(*source, F.col(offset).alias(COMMITTED))
    both = offsets.select(*source, COMMITTED).unionByName(come)
    return both.groupBy(*source).agg(F.max(COMMITTED).alias(COMMITTED)).where(F.col(COMMITTED).isNotNull())


def distinct_keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def having_keys(df: DataFrame, wanted: DataFrame, keys: Sequence[str] = NATURAL_KEY) -> DataFrame:
    """Rows whose key occurs in ``wanted``; repeats there collapse before the exchange."""
    return df.join(distinct_keys(wanted, *keys), list(keys), "left_semi")


def without_keys(df: DataFrame, gone: DataFrame, keys: Sequence[str] = NATURAL_KEY) -> DataFrame:
    """Rows whose key does not occur in ``gone``; keys are matched as tuples."""
    return df.join(distinct_keys(gone, *keys), list(keys), "left_anti")


def drop_redelivered(df: DataFrame, record_id: str = "record_id") -> DataFrame:
    """One row per record id. Optional: without it a redelivered record counts again."""
    return df.dropDuplicates([record_id])
