"""Dropping redelivered records for good, by the ranges of sample numbers already seen.

A sender numbers its samples. State holds, per key and block of numbers, the ranges that have
come, merged where they touch, instead of every id for some days: it is as large as the gaps,
however long the stream runs, and a record is known again however late its copy comes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.windows import KEYS

KEY, NUMBER, BLOCK = "key_json", "number_filled", "number_block"
#: The block of records without a number.
UNNUMBERED = -(1 << 62)
#: Numbers in a block; a key's blocks are spread over all tasks.
BLOCK_NUMBERS = 1 << 20
_STATE = "seen"
_STATE_DDL = "ranges array<struct<low: bigint, high: bigint>>"


def merged(ranges: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Ranges, rows of first and last number, with some numbers added."""
    low = np.concatenate([ranges[:, 0], numbers])
    high = np.concatenate([ranges[:, 1], numbers])
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    # A range begins where the one before ends more than one below.
    begins = np.append(True, low[1:] - 1 > high[:-1])[: len(low)]
    ends = np.append(begins[1:], True)[: len(low)]
    return np.stack([low[begins], high[ends]], axis=1)


def within(ranges: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Whether each number is in one of the ranges, which are in order."""
    if not len(ranges):
        return np.zeros(len(numbers), bool)
    at = np.searchsorted(ranges[:, 0], numbers, "right") - 1
    return (at >= 0) & (numbers <= ranges[np.maximum(at, 0), 1])


class FirstDelivery(StatefulProcessor):
    """Lets the first record of each number pass, for one key and block."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(_STATE, _STATE_DDL)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.state.get()
        ranges = np.array([tuple(r) for r in held[0]] if held else [], np.int64).reshape(-1, 2)
        for batch in rows:
            if key[1] == UNNUMBERED:
                yield batch
                continue
            numbers = batch[NUMBER].to_numpy(np.int64)
            _, first = np.unique(numbers, return_index=True)
            new = np.zeros(len(numbers), bool)
            new[first] = True
            new &= ~within(ranges, numbers)
            ranges = merged(ranges, numbers[new])
            if new.any():
                yield batch[new]
        if len(ranges):
            self.state.update(([tuple(r) for r in ranges.tolist()],))

    def close(self) -> None:
        pass


def first_deliveries(
    df: DataFrame,
    number: str,
    keys: Sequence[str] = KEYS,
    block_numbers: int = BLOCK_NUMBERS,
) -> DataFrame:
    """The records of a stream without those whose key and number have come before.

    ``number`` is a whole-numbered column. Records without a number can't be known again and
    all pass; a null key is a key. Use append mode, and start the query within
    :func:`tidemark.streaming.stateful.rocksdb_state`.
    """
    # Keys of state come by way of pandas, which has no nulls in whole numbers.
    filled = F.coalesce(F.col(number).cast("long"), F.lit(0))
    block = F.floor(filled / F.lit(block_numbers)).cast("long")
    placed = df.withColumns(
        {
            KEY: F.to_json(F.struct(*keys)),
            NUMBER: filled,
            BLOCK: F.when(F.col(number).isNull(), UNNUMBERED).otherwise(block),
        }
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in placed.schema])
    passed = placed.groupBy(KEY, BLOCK).transformWithStateInPandas(
        statefulProcessor=FirstDelivery(),
        outputStructType=schema,
        outputMode="Append",
        timeMode="None",
    )
    return passed.drop(KEY, NUMBER, BLOCK)


def seen_ranges(spark: SparkSession, checkpoint: str, keys: str = "sat_id string") -> DataFrame:
    """The columns ``keys``, given with their types, and ``number_block, low, high``: what a
    stopped query's state holds."""
    stored = spark.read.format("statestore").option("stateVarName", _STATE).load(checkpoint)
    return stored.select(
        F.from_json(f"key.{KEY}", keys).alias("k"),
        F.col(f"key.{BLOCK}").alias(BLOCK),
        F.inline("value.ranges"),
    ).select("k.*", BLOCK, "low", "high")
