"""Serving tables whose upserts and lookups leave the stored rows where they are.

A table is partitioned by day, and every day's files are bucketed and sorted by the
natural key. A batch is exchanged once into the table's buckets; comparing it with the
stored rows, folding it in and looking keys up are then joins of bucket with bucket, with
no exchange of the stored side, however large it has become. A bucket task rewrites its
own file of each day it changes, so a day always has one file per bucket.

The catalog keeps the layout, so these tables have a name. A session whose catalog does not
know it yet, over files written before, finds them by :func:`ensure` with the same location.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.files import exists
from tidemark.operators.revisions import NATURAL_KEY, REVISION, keep_latest
from tidemark.operators.windows import START
from tidemark.session import settle
from tidemark.sinks.lake import DAY, day_of, enforce_schema

# A hash table of so many rows of a batch fits a task; beyond it both sides are sorted.
HASH_ROWS = 500_000
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def ensure(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str,
    *,
    buckets: int,
    keys: Sequence[str] = NATURAL_KEY,
) -> DataFrame:
    """The named table, declared over ``location`` if the catalog does not have it.

    Choose ``buckets`` so that one bucket of a day's rows makes a file of useful size. A
    table that exists with another number or other keys is an error: its files would
    have to be dealt anew.
    """
    known = spark.catalog.tableExists(name)
    if not known:
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != DAY
        )
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `{DAY}` int) USING parquet "
            f"PARTITIONED BY (`{DAY}`) CLUSTERED BY ({by}) SORTED BY ({by}) "
            f"INTO {buckets} BUCKETS LOCATION '{location}'"
        )
        if exists(spark, location):
            spark.catalog.recoverPartitions(name)
    held = _layout(spark, name)
    if held != (list(keys), buckets):
        raise ValueError(f"{name} is bucketed as {held}, not as {(list(keys), buckets)}")
    return spark.table(name)


def upsert(batch: DataFrame, name: str, *, revision: str = REVISION) -> int:
    """Fold ``batch`` into the table and return the rows it was reduced to.

    A row replaces the stored one with its exact key only with a higher revision, so a
    batch applied again, or an older one later, changes nothing, and then nothing is
    written. Of equal revisions in a batch one row stays; an empty batch does nothing. A
    null in a key column is an error, as such rows would never meet the stored ones. Only
    days with a newer row are rewritten, swapped in one after the other: like every
    serving table this one can be rebuilt from the changelog, and is not the record.
    """
    spark = batch.sparkSession
    keys, buckets = _layout(spark, name)
    table = spark.table(name)
    schema = T.StructType(
        [T.StructField(f.name, f.dataType, f.name not in keys) for f in table.schema.fields]
    )
    latest = keep_latest(
        _dealt(batch.withColumn(DAY, day_of(F.col(START))), buckets, keys), keys, revision, seq=keys
    )
    incoming = enforce_schema(latest, schema).persist()
    newer = incoming
    try:
        per_day = incoming.groupBy(DAY).count().collect()  # a row per folder
        n = sum(row["count"] for row in per_day)
        if n == 0:
            return 0
        join = _join_hint(n, buckets)
        held = _days(table, (row[DAY] for row in per_day))
        held = held.select(*keys, F.col(revision).alias("_held"))
        known = incoming.hint(join).join(held, keys, "left")
        newer = known.where(F.col("_held").isNull() | (F.col(revision) > F.col("_held")))
        newer = newer.select(*schema.names).persist()
        changed = [row[DAY] for row in newer.select(DAY).distinct().collect()]
        if not changed:
            return n
        _overwrite(_folded(_days(table, changed), newer, keys, join), name)
        return n
    finally:
        if newer is not incoming:
            newer.unpersist()
        incoming.unpersist()


def lookup(wanted: DataFrame, name: str) -> DataFrame:
    """The stored rows whose natural key is in ``wanted``, which only needs the key columns.

    The wanted keys go to the buckets; days that none of them lies in are not read. A key
    wanted twice gives its row once, one that is null or not stored gives none.
    """
    spark = wanted.sparkSession
    keys, buckets = _layout(spark, name)
    table = spark.table(name)
    kinds = {f.name: f.dataType for f in table.schema.fields}
    asked = wanted.select(*[F.col(k).cast(kinds[k]).alias(k) for k in keys]).dropna()
    asked = settle(_dealt(asked, buckets, keys))
    per_day = asked.groupBy(day_of(F.col(START)).alias(DAY)).count().collect()
    inside = _days(table, (row[DAY] for row in per_day))
    join = _join_hint(sum(row["count"] for row in per_day), buckets)
    return inside.join(asked.hint(join), keys, "left_semi").drop(DAY)


def _folded(stored: DataFrame, newer: DataFrame, keys: Sequence[str], join: str) -> DataFrame:
    """Stored rows with the newer ones in their place or beside them, bucket by bucket."""
    names = stored.columns
    old = stored.select(*keys, F.struct(*names).alias("_old"))
    new = newer.select(*keys, F.struct(*names).alias("_new"))
    both = old.join(new.hint(join), keys, "full")
    return both.select(F.coalesce("_new", "_old").alias("r")).select("r.*")


def _join_hint(rows: int, buckets: int) -> str:
    """Hash the batch, which leaves stored rows unsorted, if a bucket of it fits a task."""
    return "shuffle_hash" if rows <= HASH_ROWS * buckets else "merge"


def _dealt(df: DataFrame, buckets: int, keys: Sequence[str]) -> DataFrame:
    """Rows in as many partitions as there are buckets, by the table's own hash."""
    return df.repartition(buckets, *keys)


def _days(table: DataFrame, days: Iterable[int]) -> DataFrame:
    return table.where(F.col(DAY).isin(sorted(days)))


def _overwrite(rows: DataFrame, name: str) -> None:
    conf = rows.sparkSession.conf
    before = conf.get(OVERWRITE_MODE)
    conf.set(OVERWRITE_MODE, "dynamic")
    try:
        rows.write.insertInto(name, overwrite=True)
    finally:
        conf.set(OVERWRITE_MODE, before)


def _layout(spark: SparkSession, name: str) -> tuple[list[str], int]:
    """Bucket columns and number, as the catalog has them."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    if "Num Buckets" not in told:
        raise ValueError(f"{name} is not bucketed")
    columns = told["Bucket Columns"].strip("[]").replace("`", "").split(", ")
    return columns, int(told["Num Buckets"])
