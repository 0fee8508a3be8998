"""Joining a large table to a small derived one without trusting it to be small."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import broadcast_bytes, broadcast_rows

SALT = "_salt"
_COPY = "_salt_copy"
SALTS = 64


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread: str,
    at_most: int | None = None,
) -> DataFrame:
    """Left join ``big`` to ``small`` (at most one match per row).

    ``small`` must already be settled, so counting it is cheap; ``at_most`` is an upper
    bound on its rows where the caller has counted already. Within the bounds of rows and
    bytes it is broadcast and ``big`` does not move. Beyond it both sides shuffle on the join
    columns plus a salt taken from column ``spread``, so that one hot join value is
    shared by many tasks and the join's partitioning is never mistaken for a usable
    grouping of the rows.
    """
    on = list(on)
    spark = big.sparkSession
    if at_most is None:
        at_most = small.count()
    # Null is a value here: a group of rows without a key is a group like any other.
    mine = {k: f"_of_{k}" for k in on}
    small = small.withColumnsRenamed(mine)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(m)) for k, m in mine.items()])
    if at_most <= broadcast_rows(spark) and _bytes(small, at_most) <= broadcast_bytes(spark):
        return big.join(F.broadcast(small), same, "left").drop(*mine.values())
    salted = big.withColumn(SALT, F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    copies = small.withColumn(_COPY, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = salted.join(copies.hint("merge"), same & (F.col(SALT) == F.col(_COPY)), "left")
    return joined.drop(SALT, _COPY, *mine.values())


def _bytes(small: DataFrame, rows: int) -> int:
    """Bytes of a settled table: measured where values have any width, else a word each."""
    wide = [
        F.coalesce(F.sum(F.octet_length(F.col(f.name).cast("string"))), F.lit(0))
        for f in small.schema
        if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.TimestampType, T.DateType))
    ]
    measured = sum(small.agg(*wide).first()) if wide and rows else 0
    return measured + 16 * rows * len(small.columns)
