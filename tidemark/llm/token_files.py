"""Token ids as Parquet: list columns of 32-bit ids in files ordered by document.

The files are written by Spark's own Parquet writer with small row groups, short pages and
page indexes, so that a reader of a few documents or of the lengths alone fetches only
those pages. Ids are dictionary encoded (a vocabulary of up to 65,536 ids takes 16 bits or
less per token); document ids and lengths, which ascend or stay small, are delta encoded.

Layout: ``doc_id, at, n_tokens, ids``, ascending by document id within and across files; the
order of the file names is the order of the documents, and ``at`` counts the ids before a
document in the range of documents that one task wrote.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import as_lists, bounded_batches, by_bytes, texts
from tidemark.llm.token_counts import KEEP_BYTES, Remembered, load

#: A single space or line break between two other characters: this kind of tokenizer starts
#: a new piece before such a space, and both before and after such a line break. (The
#: blank comes first in the pattern, as a search for a given character is a fast one.)
LINE = re.compile(r"\n(?<=\S\n)(?=\S)")
WORD = re.compile(r" (?<=\S )(?=\S)")

ROW_GROUP_BYTES = 8 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 1_000
#: Bytes of text in an Arrow batch, and taken apart at once: the more, the fewer distinct segments.
TEXT_BYTES = 4 << 20
#: Segments remembered per Python worker, about 200 bytes each.
REMEMBERED = 600_000
#: Rows per file at most.
FILE_ROWS = 200_000


#: Where a text holds none of these, every blank and line break is such a one.
OTHERWISE = (
    r"[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    r"|[ \n][ \n]|\A[ \n]|[ \n]\z"
)


def _cut(text: str) -> list[str]:
    """Segments of any text; those that begin a line have a line break before them."""
    lines = (WORD.split(line) for line in LINE.split(text))
    return [segment for first, *words in lines for segment in ("\n" + first, *words)]


def segments(column: pa.LargeStringArray) -> pa.ListArray:
    """``_cut`` of each text; of those without other white space, in one pass over the column."""
    otherwise = pc.match_substring_regex(column, OTHERWISE)
    usual = column.filter(pc.invert(otherwise))
    marked = pc.replace_substring(usual, "\n", " \n")
    empty, newline = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
    found = pc.split_pattern(pc.binary_join_element_wise(newline, marked, empty), " ")
    if len(usual) == len(column):
        return found
    by_hand = pa.array(map(_cut, column.filter(otherwise).to_pylist()), found.type)
    is_other = otherwise.to_numpy(zero_copy_only=False)
    places = np.where(is_other, len(usual) + np.cumsum(is_other), np.cumsum(~is_other)) - 1
    return pa.concat_arrays([found, by_hand]).take(pa.array(places))


#: A word and the marks after it, which this kind of tokenizer takes apart just there.
SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)")


def byte_alphabet() -> dict[int, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones as they are."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: b for b in printable} | {b: 256 + k for k, b in enumerate(others)}


class Segments(Remembered):
    """What segments are encoded to; one that isn't known is learnt where it is looked up."""

    def __init__(self, limit: int, learn: Callable[[str], bytes]):
        super().__init__(limit)
        self.learn, self.long_ones = learn, []

    def __missing__(self, segment: str) -> bytes:
        found = self[segment] = self.learn(segment)
        if len(segment) > KEEP_BYTES:
            self.long_ones.append(segment)
        return found

    def trim_after(self, used: Callable[[], set[str]]) -> None:
        """``trim``; what the batch used is gathered only where some must go."""
        self.trim(self.long_ones, used() if len(self) > self.limit else set())
        self.long_ones = []


@functools.lru_cache(2)
def encoder(path: str, remembered: int = REMEMBERED) -> Callable[[list[bytes | None]], list[bytes]]:
    """A function from texts to their ids as little-endian unsigned 32-bit integers.

    A text is cut where its pieces are independent; each distinct segment of a part is looked
    up once, and one that is remembered isn't encoded again. Segments of a word and marks go to
    the tokenizer's model directly, as the two pieces they are, all others through its whole
    encoding. Kept between the tasks of a worker.
    """
    tokenizer, alphabet = load(path), byte_alphabet()
    tokenize = tokenizer.model.tokenize
    blank = chr(alphabet[ord(" ")])
    marks: dict[str, bytes] = {}

    def packed(ids: list[int]) -> bytes:
        return ids[0].to_bytes(4, "little") if len(ids) == 1 else array("I", ids).tobytes()

    def piece(before: str, text: str) -> bytes:
        return packed([t.id for t in tokenize(before + text.encode().decode("latin-1").translate(alphabet))])

    def encoded(text: str) -> bytes:
        return packed(tokenizer.encode(text, add_special_tokens=False).ids)

    newline = encoded("\n")

    def learn(segment: str) -> bytes:
        if segment.isascii() and segment.isalpha():  # most are, and are written as they are
            return packed([t.id for t in tokenize(blank + segment)])
        if segment.startswith("\n"):
            start, before, first, text = newline, "", "", segment[1:]
        else:
            start, before, first, text = b"", " ", blank, segment
        if not (simple := SIMPLE.fullmatch(text)):
            return start + encoded(before + text)
        word, after = simple.groups()
        if not after:
            return start + piece(first, word)
        tail = marks.get(after)
        if tail is None:
            tail = piece("", after)
            if len(after) < 4:  # few enough to keep them all
                marks[after] = tail
        return (known[segment[: -len(after)]] if len(word) < KEEP_BYTES else start + piece(first, word)) + tail

    known = Segments(remembered, learn)

    def encode(batch: list[bytes | None]) -> list[bytes]:
        out: list[bytes] = []
        for part in by_bytes((t or b"" for t in batch), TEXT_BYTES):
            found = segments(pa.array(part, pa.large_binary()).cast(pa.large_string()))
            each, offsets = found.values.dictionary_encode(), found.offsets
            del found
            used = each.dictionary.to_numpy(zero_copy_only=False).tolist()
            ids = pa.array([known[segment] for segment in used], pa.large_binary()).take(each.indices)
            joined = pc.binary_join(pa.ListArray.from_arrays(offsets, ids), pa.scalar(b"", ids.type))
            out += [row[len(newline) :] for row in joined.to_pylist()]  # but for the mark of the first line
            known.trim_after(lambda: set(used))
        return out

    return encode


def write_token_files(
    docs: DataFrame, path: str, out: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Encode every text, append ``end_id`` and write the token files to the folder ``out``.

    Texts move once, to ranges of document ids; a range is encoded where it is written.
    Null texts are encoded as empty ones. Rows without an id come first; rows that share an
    id lie side by side, ordered by their texts. An empty table writes no rows.
    """
    bounded_batches(docs.sparkSession, TEXT_BYTES)
    end = np.asarray([end_id], "<u4").tobytes()

    def encode_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, before = encoder(path), 0
        for batch in batches:
            packed = [p + end for p in encode(texts(batch.column(1)))]
            n = np.asarray([len(p) // 4 for p in packed], np.int64)
            at = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(at), pa.array(n), as_lists(packed)],
                ["doc_id", "at", "n_tokens", "ids"],
            )

    id_type = docs.schema[doc_id].dataType.simpleString()
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange(*order[:2])
        .sortWithinPartitions(*order)
        .mapInArrow(encode_range, f"doc_id {id_type}, at long, n_tokens long, ids array<int>")
        .write.option("maxRecordsPerFile", FILE_ROWS)
        .option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#at", "false")
        .option("parquet.enable.dictionary#n_tokens", "false")
        .parquet(out)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from token files, whichever of them are selected.

    ``start`` is the number of ids in all documents before: what the file says of its
    range, plus a running sum over the ranges. That table has a row per task that wrote, a
    number the driver schedules by, so it is broadcast. Ids don't move.
    """
    id_type = spark.read.parquet(path).schema["doc_id"].dataType.simpleString()
    rows = spark.read.schema(f"doc_id {id_type}, at long, n_tokens long, ids array<int>").parquet(path)
    rows = rows.withColumn("_range", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int"))
    ranges = rows.groupBy("_range").agg(F.max(F.col("at") + F.col("n_tokens")).alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(ranges), "_range").select(
        "doc_id", (F.col("_before") + F.col("at")).alias("start"), "n_tokens", "ids"
    )


def ids_crc32(ids: Column) -> Column:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf(T.LongType())
    def crc(batch: pa.Array) -> pa.Array:
        flat = np.ascontiguousarray(batch.flatten().to_numpy(zero_copy_only=False), "<i4")
        ends = np.cumsum(batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        data, out, at = memoryview(flat).cast("B"), [], 0
        for end in ends:
            out.append(zlib.crc32(data[4 * at : 4 * end]))
            at = int(end)
        return pa.array(out, pa.int64())

    return crc(ids)
