"""What the operators of this subpackage share: tables, files between jobs, Arrow batches."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

#: Arrow batches handed to Python hold at most so many rows and bytes of text.
BATCH_ROWS = 2_000
BATCH_BYTES = 8 << 20
#: The same where a worker makes many times as much of its batch, or several work at once.
SMALL_BATCH_BYTES = 2 << 20
#: Bytes of text that are taken apart into words at once.
PART_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches small, whatever the length of the texts in them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again.

    Cuts the lineage: a lost executor costs later readers nothing, and no reader computes
    the rows a second time. Unlike a checkpoint, a reader fetches only the columns it uses.
    """
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the rows that no model may learn from: crc32 of the id's text in fold 0."""
    return F.crc32(doc_id.cast("string")) % folds == 0


def texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each text of a batch, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def by_bytes(items: Iterable, limit: int, size=len) -> Iterator[list]:
    """Consecutive items in lists of at most ``limit`` bytes, or of one longer item."""
    batch, total = [], 0
    for item in items:
        n = size(item)
        if batch and total + n > limit:
            yield batch
            batch, total = [], 0
        batch.append(item)
        total += n
    if batch:
        yield batch


def as_lists(packed: list[bytes | None], kind: str = "<i4") -> pa.Array:
    """Integers of one kind, packed by row, as an Arrow list array."""
    width = np.dtype(kind).itemsize
    ends = np.cumsum([0, *(len(p or b"") // width for p in packed)], dtype=np.int64).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(p or b"" for p in packed), kind))
    mask = pa.array([p is None for p in packed], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=mask)


def unlike(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have."""
    names = {c.lower() for c in df.columns}
    return next(n for n in itertools.chain([base], (f"{base}_{i}" for i in itertools.count())) if n not in names)
