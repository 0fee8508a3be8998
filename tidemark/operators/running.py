"""Running aggregates in a total order, for groups of any size.

A window function alone puts each group into one task: with no partition column that
is the whole table, and with a hot key it may be a third of it. Here a group larger
than ``target`` rows is cut into consecutive chunks of its order column, each chunk is
scanned by its own task, and what came before a chunk enters it as one extra,
pre-aggregated row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.lookup import lookup_join
from tidemark.session import settle

TARGET_ROWS_CONF = "tidemark.running.targetRows"
TARGET_ROWS_DEFAULT = 4_000_000

# What a task may sort and hold of a group that it scans; by this wide rows make smaller chunks.
TARGET_BYTES = 256 << 20

# So many totals of chunks are scanned by one task, whatever the target.
LEAST_TOTALS = 10_000

CHUNK = "_chunk"
_CARRIED = "_carried"
_CHUNK_OF = "_chunk_of"
_FIRST = "_first_of_chunk"
_ROWS = "_rows_of_chunk"
_MAX_CELLS = 4096
_COMBINE = {"sum": F.sum, "min": F.min, "max": F.max}


def target_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(TARGET_ROWS_CONF, str(TARGET_ROWS_DEFAULT)))


def fitting_rows(df: DataFrame, aggs: int) -> int:
    """Rows of a chunk of ``df`` with so many running columns: the target, or what fits a task."""
    wide = sum(
        1 if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.TimestampType, T.DateType)) else 4
        for f in df.schema
    )
    # A value is in the row that is sorted and in the one that comes out.
    return min(target_rows(df.sparkSession), max(1, TARGET_BYTES // (16 * (wide + aggs))))


def split_hot_groups(
    df: DataFrame, keys: Sequence[str], order: str, target: int
) -> tuple[DataFrame, bool]:
    """Add ``_chunk``, an array that sorts like ``order`` within a group.

    Groups of at most ``target`` rows keep the empty chunk. A larger one is divided
    into equal-width cells over its own range of ``order``; a cell that is still too
    large is divided again over *its* range, until every cell fits or holds a single
    order value. Infinities are cells of their own. Each pass only counts. The cells that
    need dividing number fewer than rows / target, which is what bounds the lookup table.
    """
    integral = not isinstance(df.schema[order].dataType, (T.FloatType, T.DoubleType))
    at = F.col(order)
    finite = F.lit(True) if integral else F.abs(at) < F.lit(float("inf"))
    rows = df.withColumn(CHUNK, F.array().cast("array<bigint>"))
    before: tuple[int, int] | None = None
    while True:
        crowded = settle(
            rows.groupBy(*keys, CHUNK)
            .agg(
                F.count(F.lit(1)).alias("_n"),
                F.min(F.when(finite, at)).alias("_lo"),
                F.max(F.when(finite, at)).alias("_hi"),
                F.count_if(~finite).alias("_odd"),
            )
            .where(F.col("_n") > target)
            .where((F.col("_hi") > F.col("_lo")) | ((F.col("_odd") > 0) & (F.col("_odd") < F.col("_n"))))
            .select(*keys, CHUNK, "_n", "_lo", _cell_width(integral, target).alias("_width"))
        )
        found = crowded.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
        if not found[0]:
            return rows, before is not None
        if tuple(found) == before:
            raise RuntimeError(f"{found[1]} rows by {order} can't be divided into chunks of {target}")
        before = tuple(found)
        rows = (
            lookup_join(rows, crowded.drop("_n"), [*keys, CHUNK], spread=order)
            .withColumn(
                CHUNK,
                F.when(
                    F.col("_width").isNotNull(), F.concat(CHUNK, F.array(_cell(order, integral)))
                ).otherwise(F.col(CHUNK)),
            )
            .drop("_lo", "_width")
        )


def _cell_width(integral: bool, target: int) -> Column:
    # Four cells per target-sized share leaves room for uneven spread; fewer where these
    # would hold a row or two each.
    finer = min(4, max(1, target // 4))
    cells = F.least(F.lit(_MAX_CELLS), F.ceil(F.col("_n") / F.lit(target)) * finer)
    lo, hi = F.col("_lo").cast("double"), F.col("_hi").cast("double")
    # A whole-numbered width below the span, but at least 1, always separates lo from hi.
    # Divided before the subtraction, the span of any two doubles stays finite.
    if integral:
        return ((hi - lo) / cells + 1).cast("decimal(38,0)")
    return F.coalesce(hi / cells - lo / cells, F.lit(0.0))


def _cell(order: str, integral: bool) -> Column:
    """The number of a row's cell; it ascends with the order."""
    if integral:
        return F.expr(f"(`{order}` - _lo) div _width").cast("bigint")
    at, lo, width = F.col(order), F.col("_lo"), F.col("_width")
    inside = F.when(width > 0, F.floor(at / width - lo / width)).otherwise((at > lo).cast("bigint"))
    # NaN sorts above everything, like Spark's own order.
    return (
        F.when(at == float("-inf"), -(1 << 40))
        .when((at == float("inf")) | F.isnan(at), F.when(F.isnan(at), (1 << 40) + 1).otherwise(1 << 40))
        .otherwise(F.coalesce(inside, F.lit(0)))
        .cast("bigint")
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    aggs: Mapping[str, tuple[str, str]],
    *,
    inclusive: bool = True,
    target: int | None = None,
    at_most: int | None = None,
    sizes: DataFrame | None = None,
    undivided: bool = False,
) -> DataFrame:
    """Add running ``sum``/``min``/``max`` columns: ``{out: (kind, column)}``.

    ``order`` is one numeric, non-null column, unique within a group. With
    ``inclusive=False`` the current row is left out and a group's first row gets null.
    Where the caller knows more, it saves the pass that looks for large groups:
    ``at_most`` bounds the rows of ``df``, and ``sizes`` has a column ``n`` with a bound
    for every group that might be large. ``undivided`` scans every group whole.
    """
    keys = list(keys)
    if target is None:
        target = fitting_rows(df, len(aggs))
    if undivided or (at_most is not None and at_most <= target) or (
        sizes is not None and sizes.where(F.col("n") > target).isEmpty()
    ):
        rows, divided = df.withColumn(CHUNK, F.lit(None)), False
    else:
        rows, divided = split_hot_groups(df, keys, order, target)
    last = 0 if inclusive else -1

    if not divided:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, last)
        return rows.drop(CHUNK).withColumns(
            {out: _COMBINE[kind](col).over(w) for out, (kind, col) in aggs.items()}
        )

    columns = {col: kind for kind, col in aggs.values()}
    if len(columns) != len(set(aggs.values())):
        raise ValueError("one column cannot be combined in two ways; copy it first")
    totals = settle(
        rows.where(F.size(CHUNK) > 0)
        .groupBy(*keys, CHUNK)
        .agg(
            *[_COMBINE[kind](col).alias(col) for col, kind in columns.items()],
            F.min(order).alias(_FIRST),
            F.count(F.lit(1)).alias(_ROWS),
        )
    )
    # A row holds the type of what it is combined into, so that dividing changes no result.
    held = {f.name: f.dataType for f in totals.schema if f.name in columns}
    rows = rows.withColumns({col: F.col(col).cast(kind) for col, kind in held.items()})
    wanted = df.select(*[_COMBINE[kind](col).alias(out) for out, (kind, col) in aggs.items()]).schema
    chunks, held_rows = totals.agg(F.count(F.lit(1)), F.sum(_ROWS)).first()
    # Chunks follow each other like their first rows, so what came before each is a running
    # aggregate again, over fewer rows. Where they are few, or no fewer, one scan has to do.
    carried = running(
        totals.withColumnRenamed(CHUNK, _CHUNK_OF),
        keys,
        _FIRST,
        {f"_before_{col}": (kind, col) for col, kind in columns.items()},
        inclusive=False,
        target=target,
        at_most=chunks,
        undivided=chunks <= LEAST_TOTALS or 2 * chunks > held_rows,
    ).select(
        *keys,
        F.col(_CHUNK_OF).alias(CHUNK),
        *[F.col(f"_before_{col}").cast(held[col]).alias(col) for col in columns],
        F.lit(0).alias(_CARRIED),
    )
    within = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(_CARRIED, order)
        .rowsBetween(Window.unboundedPreceding, last)
    )
    return (
        rows.withColumn(_CARRIED, F.lit(1))
        .unionByName(carried, allowMissingColumns=True)
        .withColumns(
            {
                out: _COMBINE[kind](col).over(within).cast(wanted[out].dataType)
                for out, (kind, col) in aggs.items()
            }
        )
        .where(F.col(_CARRIED) == 1)
        .drop(CHUNK, _CARRIED)
        .withColumns({col: F.col(col).cast(df.schema[col].dataType) for col in held})
    )
