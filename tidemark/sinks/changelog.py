"""The changelog: every emission, stored once per stream query and batch.

A batch owns the folder ``query_id=…/batch_id=…`` and overwrites it as a whole, so a
batch that is run again after a failure leaves the same rows behind. It counts once the log
of commits has a line for it, a small file that appears at once; readers join the log.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.files import exists, remove, write_text
from tidemark.operators.lookup import lookup_join
from tidemark.operators.revisions import NATURAL_KEY, REVISION, keep_latest
from tidemark.operators.windows import KEYS, START
from tidemark.session import settle
from tidemark.sinks.lake import upsert

BATCH = ("query_id", "batch_id")
COUNTERS = (
    "records_in",
    "on_time",
    "late_accepted",
    "dead_lettered",
    "windows_fired",
    "window_updates",
)
COMMIT = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        *(T.StructField(c, T.LongType()) for c in COUNTERS),
        T.StructField("upto", T.LongType()),
        T.StructField("seen", T.StringType()),
    ]
)


def batch_path(path: str, query_id: str, batch_id: int) -> str:
    return f"{path}/query_id={query_id}/batch_id={batch_id}"


def write_batch(df: DataFrame, path: str, query_id: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(batch_path(path, query_id, batch_id))


def commit_path(path: str, query_id: str, batch_id: int) -> str:
    return f"{path}/commits/{query_id}-{batch_id}.json"


def commit_batch(
    spark: SparkSession,
    path: str,
    query_id: str,
    batch_id: int,
    counted: Mapping[str, int],
    seen: Mapping,
) -> None:
    """Make a batch visible, with its counters and what the next one goes on from."""
    line = {"query_id": query_id, "batch_id": batch_id, **counted, "seen": json.dumps(seen)}
    write_text(spark, commit_path(path, query_id, batch_id), json.dumps(line))


def uncommit_batch(spark: SparkSession, path: str, query_id: str, batch_id: int) -> None:
    """Hide a batch before its tables are written again."""
    remove(spark, commit_path(path, query_id, batch_id))


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The log below ``path``: a row per committed batch, one for all that were compacted."""
    log = spark.read.schema(COMMIT).json(f"{path}/commits")
    newest = F.max("upto").over(Window.partitionBy("query_id"))
    held = F.col("_newest").isNull() | (F.coalesce("upto", "batch_id") >= F.col("_newest"))
    # The batch that a compaction ends with is in it.
    inside = F.col("upto").isNull() & (F.col("batch_id") <= F.coalesce("_newest", F.lit(-1)))
    return log.withColumn("_newest", newest).where(held & ~inside).drop("_newest")


def compacted_id(upto: int) -> int:
    """The number of the folder that holds all batches up to ``upto``."""
    return -upto - 1


def compact(
    spark: SparkSession,
    path: str,
    query_id: str,
    upto: int,
    tables: Sequence[str] = ("changelog", "dead_letters"),
    rows_per_file: int = 4_000_000,
) -> int:
    """Put the committed batches of a query up to ``upto`` into few files, by window start.

    Batches don't change once they are committed; ``upto`` should leave out the last, which
    may still be run again. Files follow each other in time, so that a reader of some days
    opens some files. The line in the log makes readers change over at once. What is no
    longer in use stays until the compaction after this one, for readers that have begun;
    then its folders go. Returns how many batches were put together.
    """
    log = of_query(commits(spark, path), query_id)
    mine = log.where(F.coalesce("upto", "batch_id") <= upto)
    totals = mine.agg(
        F.count(F.lit(1)), F.max("upto"), *[F.coalesce(F.sum(c), F.lit(0)) for c in COUNTERS]
    ).first()
    if totals[0] < 2:
        return 0  # nothing to put together
    target = compacted_id(upto)
    for table in tables:
        if not exists(spark, f"{path}/{table}"):
            continue
        rows = committed(of_query(read_batches(spark, f"{path}/{table}"), query_id), mine)
        rows = rows.drop(*BATCH)
        files = max(1, -(-rows.count() // rows_per_file))
        rows.repartitionByRange(files, START).sortWithinPartitions(START).write.mode(
            "overwrite"
        ).parquet(batch_path(f"{path}/{table}", query_id, target))
    counted = dict(zip(COUNTERS, totals[2:]))
    line = {"query_id": query_id, "batch_id": target, "upto": upto, **counted, "seen": "{}"}
    write_text(spark, f"{path}/commits/{query_id}-upto-{upto}.json", json.dumps(line))
    _forget_replaced(spark, path, query_id, tables, totals[1])
    return totals[0]


def _forget_replaced(
    spark: SparkSession, path: str, query_id: str, tables: Sequence[str], before: int | None
) -> None:
    """Remove the folders that the compaction up to ``before`` had replaced, newest first."""
    for batch_id in range(before if before is not None else -1, -1, -1):
        folders = [batch_path(f"{path}/{t}", query_id, i) for t in tables for i in (batch_id, compacted_id(batch_id - 1))]
        if not any([remove(spark, folder) for folder in folders]):
            break


def committed(batches: DataFrame, log: DataFrame) -> DataFrame:
    """The rows of batches that the log holds. It is broadcast if its size allows."""
    kinds = {c: batches.schema[c].dataType for c in BATCH}
    done = settle(log.select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()]).distinct())
    done = done.withColumn("_done", F.lit(True))
    return lookup_join(batches, done, BATCH, spread="batch_id").where("_done").drop("_done")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def of_query(batches: DataFrame, query_id: str) -> DataFrame:
    """The batches that one query wrote; folder names may have been read as numbers."""
    return batches.where(F.col("query_id").cast("string") == query_id)


def latest_view(
    changelog: DataFrame,
    keys: Sequence[str] = NATURAL_KEY,
    revision: str = REVISION,
) -> DataFrame:
    """Highest revision per natural key; of equal ones the earliest batch's."""
    return keep_latest(changelog, keys, revision, seq=["batch_id", "query_id"]).drop(*BATCH)


def refresh(
    changelog: DataFrame,
    serving_path: str,
    schema: T.StructType,
    *,
    after_batch_id: int = -1,
    query_id: str | None = None,
    keys: Sequence[str] = NATURAL_KEY,
    partition_by: Sequence[str] = KEYS,
) -> int:
    """Fold the batches after ``after_batch_id`` into a serving table; -1 rebuilds it.

    Batches are numbered per query; ``query_id`` tells whose are meant where several share
    the changelog.

    The serving table has one row per window in few files. Losing it loses nothing.
    """
    # A compacted batch is as new as the last one in it.
    batch_id = F.col("batch_id")
    newest = F.when(batch_id < 0, -batch_id - 1).otherwise(batch_id)
    newer = changelog.where(newest > after_batch_id)
    if query_id is not None:
        newer = of_query(newer, query_id)
    newer = newer.drop(*BATCH)
    return upsert(newer, serving_path, schema, keys=keys, partition_by=partition_by)
