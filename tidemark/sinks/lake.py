"""Window-result tables as partitioned files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.files import exists
from tidemark.operators.report import export_order
from tidemark.operators.revisions import NATURAL_KEY, REVISION, keep_latest
from tidemark.operators.windows import KEYS, START
from tidemark.session import broadcast_rows

BUCKET = "key_bucket"
DAY = "window_day"
_DAY_MS = 24 * 3_600_000


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns, order and types of ``schema``; a null in a required column is an error.

    File formats do not enforce ``nullable=False``, so the check is part of the plan.
    """
    columns = []
    for field in schema.fields:
        c = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            missing = F.raise_error(F.lit(f"null in required column {field.name}"))
            c = F.coalesce(c, missing.cast(field.dataType))
        columns.append(c.alias(field.name))
    return df.select(*columns)


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    *,
    partition_by: Sequence[str] = KEYS,
    fmt: str = "parquet",
    location: str | None = None,
) -> DataFrame:
    """The named table, created with its namespace if absent.

    With a catalog that provides it, ``fmt='iceberg'`` gives a table for ``MERGE``.
    """
    namespace, _, _table = name.rpartition(".")
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} "
        f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
        + (f" LOCATION '{location}'" if location else "")
    )
    return spark.table(name)


def merge_statement(
    target: str, source: str, columns: Sequence[str], keys: Sequence[str] = NATURAL_KEY
) -> str:
    """``MERGE`` with the revision guard, for catalogs whose tables support it.

    Of several rows with one key in ``source`` only one with the highest revision takes
    part, as ``MERGE`` refuses two.
    """
    key = ", ".join(f"`{k}`" for k in keys)
    names = ", ".join(f"`{c}`" for c in columns)
    ranked = f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY `{REVISION}` DESC) AS _rank FROM {source}"
    source = f"(SELECT {names} FROM ({ranked}) WHERE _rank = 1)"
    match = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    assign = ", ".join(f"`{c}` = s.`{c}`" for c in columns)
    values = ", ".join(f"s.`{c}`" for c in columns)
    return (
        f"MERGE INTO {target} t USING {source} s ON {match} "
        f"WHEN MATCHED AND s.`{REVISION}` > t.`{REVISION}` THEN UPDATE SET {assign} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def bucketed(df: DataFrame, buckets: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """Add a partition column for keys too numerous to be partition values themselves."""
    return df.withColumn(BUCKET, bucket_of(buckets, *[F.col(k) for k in keys]))


def laid_out(df: DataFrame, buckets: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """Add partition columns by day and key, so that a refresh touches the days it changes."""
    return bucketed(df, buckets, keys).withColumn(DAY, day_of(F.col(START)))


def day_of(start):
    return F.floor(start / _DAY_MS).cast("int")


def bucket_of(buckets: int, *key):
    """Bucket of a key; compare ``key_bucket`` with it to prune a drilldown to one folder."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def append(df: DataFrame, path: str, partition_by: Sequence[str] = KEYS) -> None:
    """Append; AQE splits the writing of a partition that is much larger than others."""
    df.hint("rebalance", *partition_by).write.mode("append").partitionBy(*partition_by).parquet(
        path
    )


def scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored columns of ``schema``; partition folders not in it prune but do not show."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def upsert(
    batch: DataFrame,
    path: str,
    schema: T.StructType,
    *,
    keys: Sequence[str] = NATURAL_KEY,
    partition_by: Sequence[str] = KEYS,
    revision: str = REVISION,
) -> int:
    """Fold ``batch`` into the table at ``path`` and return the rows it was reduced to.

    A row replaces the stored one with its exact key only with a higher revision, so
    applying a batch again, or an older batch later, changes nothing: keys and revisions
    are compared first, and where no row is newer nothing is written. Only partitions that
    hold a newer row are rewritten; partitioned by day, those are the days that the allowed
    lateness reaches. They are swapped in one after the other, so this table serves reads
    and can be rebuilt from the changelog; it is not the record.
    """
    spark = batch.sparkSession
    keys, parts = list(keys), list(partition_by)
    incoming = enforce_schema(keep_latest(batch, keys, revision, seq=keys), schema).persist()
    newer = incoming
    try:
        n = incoming.count()
        if n == 0:
            return 0
        rows = incoming
        if exists(spark, path):
            held = _within(scan(spark, path, schema), incoming, parts)
            held = held.select(*keys, F.col(revision).alias("_held"))
            known = incoming.join(held, keys, "left")
            newer = known.where(F.col("_held").isNull() | (F.col(revision) > F.col("_held")))
            newer = newer.select(*schema.names).persist()
            if newer.isEmpty():
                return n
            stored = _within(scan(spark, path, schema), newer, parts)
            kept = stored.join(newer.select(*keys), keys, "left_anti")
            rows = kept.unionByName(newer)
        (
            rows.hint("rebalance", *parts)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*parts)
            .parquet(path)
        )
        return n
    finally:
        newer.unpersist()
        incoming.unpersist()


def _within(table: DataFrame, batch: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The rows of the partitions that a cached batch touches; folders prune if these are few."""
    touched = batch.select(*parts).distinct()
    if touched.count() <= broadcast_rows(table.sparkSession):
        touched = F.broadcast(touched)
    return table.join(touched, list(parts), "left_semi")


def export_json(results: DataFrame, path: str, keys: Sequence[str] = KEYS) -> None:
    """Rows sorted by key and window as JSON lines; part files continue each other."""
    export_order(results, keys).write.mode("overwrite").json(path)
