"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts of a batch are cut at ASCII white space, the boundaries at which this tokenizer's
splitting rules start afresh, so a text of any length becomes short segments whose counts
add up. Each distinct segment of a batch is encoded once, in calls that hold about equally
many bytes; counts of short segments are remembered within a bounded memory.
"""

from __future__ import annotations

import functools
import itertools
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import PART_BYTES, bounded_batches, by_bytes, texts

#: Bytes of segments in one call of the tokenizer.
CALL_BYTES = 1 << 18
#: Segments remembered per Python worker; those longer than KEEP_BYTES are not.
REMEMBERED = 300_000
KEEP_BYTES = 64


class Remembered(dict):
    """What short segments were encoded to; ``trim`` keeps it within its bound."""

    def __init__(self, limit: int = REMEMBERED):
        super().__init__()
        self.limit = limit

    def without(self, used: set) -> list:
        """Those of ``used`` that aren't known; looks at them alone, however many are known."""
        return [key for key in used if key not in self]

    def trim(self, long_ones: list[bytes], in_use: set) -> None:
        """After a batch: forget its long segments and, when too many, the older half.

        Those that the batch used stay, as they are likely to come again.
        """
        for key in long_ones:
            self.pop(key, None)
        if len(self) > self.limit:
            for key in list(itertools.islice(self, len(self) - self.limit // 2)):
                if key not in in_use:
                    del self[key]


def load(path: str):
    """A tokenizer that keeps to the task's own core, without padding or truncation."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


@functools.lru_cache(2)
def counter(path: str, remembered: int = REMEMBERED) -> Callable[[list[bytes | None]], list[int]]:
    """A function from texts to token counts with the tokenizer file at ``path``.

    Kept between the tasks of a worker, with what it remembers.
    """
    tokenizer, known = load(path), Remembered(remembered)

    def count(batch: list[bytes | None]) -> list[int]:
        out: list[int] = []
        for part in by_bytes((t or b"" for t in batch), PART_BYTES):
            segments = [t.split() for t in part]
            used = set().union(*segments)
            fresh = sorted(known.without(used))
            for call in by_bytes(fresh, CALL_BYTES):
                encoded = tokenizer.encode_batch_fast([s.decode() for s in call], add_special_tokens=False)
                known.update(zip(call, map(len, encoded), strict=True))
            out += [sum(map(known.__getitem__, words)) for words in segments]
            known.trim([s for s in fresh if len(s) > KEEP_BYTES], used)
        return out

    return count


def token_count(text: Column, path: str) -> Column:
    """The number of tokens of each text, without special tokens added; null counts 0."""

    @F.arrow_udf(T.LongType())
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = counter(path)
        for batch in batches:
            yield pa.array(count(texts(batch)), pa.int64())

    return n_tokens(text)


def token_counts(
    docs: DataFrame, path: str, limit: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Bytes, tokens and whether they exceed ``limit``, one row per row of ``docs``.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows and null ids are counted
    like any other; other columns are not read. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(F.col(text), path).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
