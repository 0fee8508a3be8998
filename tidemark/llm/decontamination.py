"""Benchmark decontamination by suffix arrays of the training text.

Documents of an Arrow batch form a shard: their words, as numbers, one after the other. The
shard's suffixes are sorted; those that start with too few benchmark words in a row can't
match and are left out. Every suffix of a benchmark item is then looked up by binary search
for the suffixes that begin with its window, and each match is extended to its longest
verbatim length. Matches are kept where they can't be extended to the left, so that their
words are exactly those in any occurrence of a window.

A window is ``window`` consecutive words of an item, or the whole item if it has fewer. The
benchmark is sent to the tasks in slices of bounded size, which are searched one by one; one
of more than ``BENCHMARK_BYTES`` is refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, by_bytes, texts

WINDOW = 10
#: Benchmark words in one slice, and bytes of text in one shard, at most (or one item, one text).
SLICE_BYTES = 8 << 20
SHARD_BYTES = 8 << 20
#: A benchmark of more bytes of text is refused: all of it goes to every executor.
BENCHMARK_BYTES = 512 << 20

# A word is a run of digits, letters and bytes from 0x80; A-Z count as a-z.
_SPACED = bytearray(b" " * 128 + bytes(range(128, 256)))
for _b in [*range(48, 58), *range(97, 123)]:
    _SPACED[_b] = _b
for _b in range(65, 91):
    _SPACED[_b] = _b + 32
_SPACED = bytes(_SPACED)

SPAN = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("doc_start", T.IntegerType()),
        T.StructField("item_start", T.IntegerType()),
        T.StructField("n_words", T.IntegerType()),
    ]
)
MATCH = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("spans", T.ArrayType(SPAN, False)),
    ]
)


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_SPACED).split()


def known_ahead(ids: np.ndarray) -> np.ndarray:
    """For each position, how many benchmark words follow in a row, itself included."""
    gaps = np.flatnonzero(ids == 0)
    return np.append(gaps, len(ids))[np.searchsorted(gaps, np.arange(len(ids)))] - np.arange(len(ids))


class Packed:
    """The first ``depth`` words of suffixes as a few integers each, comparable in order."""

    def __init__(self, vocabulary: int, depth: int):
        self.bits = max(int(vocabulary).bit_length(), 1)
        self.words = max(1, 63 // self.bits)
        self.n_keys = -(-depth // self.words)

    def keys(self, ids: np.ndarray, at: np.ndarray, length: np.ndarray, fill: int = 0) -> np.ndarray:
        """Per position of ``at``: keys of its first ``length`` words, the rest being ``fill``."""
        out = np.zeros((self.n_keys, len(at)), np.int64)
        for i in range(self.n_keys * self.words):
            word = np.where(i < length, ids[np.minimum(at + i, len(ids) - 1)], fill)
            out[i // self.words] = out[i // self.words] << self.bits | word
        return out


class Slice:
    """Benchmark items as numbers, ready to be looked up."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        split = [(i, w) for i, w in ((i, words(t)) for i, t in items) if w]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for _, ws in split for w in ws}), 1)}
        self.item_ids = [i for i, _ in split]
        ids, item, start, need = [0], [], [], []
        for k, (_, ws) in enumerate(split):
            size = min(window, len(ws))
            first = len(ids)
            ids += [*(self.vocabulary[w] for w in ws), 0]
            n = len(ws) - size + 1
            item += [k] * n
            start += range(first, first + n)
            need += [size] * n
        self.ids = np.asarray(ids, np.int64)
        self.item, self.start, self.need = (np.asarray(x, np.int64) for x in (item, start, need))
        self.first = np.zeros(len(split), np.int64)
        if len(self.item):
            self.first[self.item[::-1]] = self.start[::-1]
            self.packed = Packed(len(self.vocabulary), int(self.need.max()))
            top = (1 << self.packed.bits) - 1
            self.low = self.packed.keys(self.ids, self.start, self.need)
            self.high = self.packed.keys(self.ids, self.start, self.need, top)

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Longest matches in a shard: suffix of the slice, position in the shard, words."""
        none = np.zeros(0, np.int64)
        if not len(self.item):
            return none, none, none
        ahead = known_ahead(ids)
        at = np.flatnonzero(ahead >= self.need.min())
        if not len(at):
            return none, none, none
        # The suffix array: positions in the order of their words, to the depth of a window.
        keys = self.packed.keys(ids, at, ahead[at])
        order = np.lexsort(keys[::-1])
        array, keys = at[order], keys[:, order]
        low, high = bound(keys, self.low, False), bound(keys, self.high, True)
        n = high - low
        suffix = np.repeat(np.arange(len(n)), n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = array[np.repeat(low, n) + offset]
        test = self.start[suffix]
        before = np.where(place > 0, ids[np.maximum(place - 1, 0)], 0)
        leftmost = (before == 0) | (before != self.ids[test - 1])
        suffix, place, test = suffix[leftmost], place[leftmost], test[leftmost]
        length = self.need[suffix].copy()
        padded = np.append(ids, 0)
        growing = np.arange(len(length))
        while len(growing):
            a = padded[np.minimum(place[growing] + length[growing], len(ids))]
            b = self.ids[test[growing] + length[growing]]
            growing = growing[(a == b) & (a > 0)]
            length[growing] += 1
        return suffix, place, length


def bound(keys: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of many key columns at once: the first place not before, or after, each."""
    lo = np.zeros(wanted.shape[1], np.int64)
    hi = np.full(wanted.shape[1], keys.shape[1], np.int64)
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        less, equal = np.zeros(len(open_), bool), np.ones(len(open_), bool)
        for have, want in zip(keys[:, mid], wanted[:, open_], strict=True):
            less |= equal & (have < want)
            equal &= have == want
        right = less | equal if after else less
        lo[open_[right]] = mid[right] + 1
        hi[open_[~right]] = mid[~right]
    return lo


def search(batch: list[bytes | None], slices: Iterator[Slice]) -> tuple[list[int], list[int], list[list[tuple]]]:
    """Words, hit words and spans of each text of a shard."""
    split = [words(t) for t in batch]
    n = np.asarray([len(w) for w in split], np.int64)
    first = np.cumsum(n + 1) - n - 1  # a gap ends each document
    size = int((n + 1).sum())
    covered = np.zeros(size + 1, np.int64)
    spans: list[list[tuple]] = [[] for _ in batch]
    for part in slices:
        ids = np.zeros(size, np.int64)
        for w, a, k in zip(split, first, n, strict=True):
            ids[a : a + k] = list(map(part.vocabulary.get, w, repeat(0)))
        suffix, place, length = part.find(ids)
        np.add.at(covered, place, 1)
        np.add.at(covered, place + length, -1)
        doc = np.searchsorted(first, place, "right") - 1
        item = part.item[suffix]
        columns = (doc, item, place - first[doc], part.start[suffix] - part.first[item], length)
        for d, i, a, b, m in zip(*(c.tolist() for c in columns), strict=True):
            spans[d].append((part.item_ids[i], a, b, m))
    hit = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    return n.tolist(), (hit[first + n] - hit[first]).tolist(), [sorted(s, key=lambda x: (x[1], str(x[0]), x[2])) for s in spans]


def broadcast_slices(benchmark: DataFrame, item_id: str, text: str) -> list[Broadcast]:
    """The benchmark in slices of about ``SLICE_BYTES``; the driver holds one at a time."""
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).filter("t is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    if total > BENCHMARK_BYTES:
        raise ValueError(f"a benchmark of {total} bytes; at most {BENCHMARK_BYTES} are sent out")
    n = -(-total // SLICE_BYTES)
    slot = F.pmod(F.xxhash64("i", "t"), F.lit(max(n, 1)))
    context = benchmark.sparkSession.sparkContext
    return [
        context.broadcast([(r.i, r.t.encode()) for r in items.filter(slot == k).collect()]) for k in range(n)
    ]


def matches(text: Column, slices: list[Broadcast], window: int = WINDOW) -> Column:
    """``n_words, n_hit, spans`` of each whole text; none of them for a null text."""

    @F.arrow_udf(MATCH)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # One slice stays ready; of several, each is made ready for a shard and dropped.
        kept = [Slice(slices[0].value, window)] if len(slices) == 1 else None
        for batch in batches:
            rows: list[dict] = []
            for shard in by_bytes(texts(batch), SHARD_BYTES, lambda t: len(t or b"")):
                ready = kept if kept is not None else (Slice(s.value, window) for s in slices)
                for n, hit, spans in zip(*search(shard, ready), strict=True):
                    spans = [dict(zip(SPAN.names, s, strict=True)) for s in spans]
                    rows.append({"n_words": n, "n_hit": hit, "spans": spans})
            yield pa.array(rows, _ARROW)

    return of(text)


_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        (
            "spans",
            pa.list_(
                pa.struct(
                    [("item_id", pa.string()), ("doc_start", pa.int32()), ("item_start", pa.int32()), ("n_words", pa.int32())]
                )
            ),
        ),
    ]
)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
) -> DataFrame:
    """``doc_id, n_words, n_hit, spans`` of every row of ``docs``.

    A span says which item, at which word of it and of the document, and how many words
    match verbatim. Null and empty texts, on either side, have no words and match nothing.
    Items that repeat an id are matched each; a null item id stays null in spans. Repeated
    documents are rows like any other. Without a benchmark nothing is hit; an empty table
    gives no rows. Columns that are not named are not read.
    """
    bounded_batches(docs.sparkSession)
    slices = broadcast_slices(benchmark, item_id, text)
    found = docs.select(F.col(doc_id).alias("doc_id"), matches(F.col(text), slices, window).alias("m"))
    return found.select("doc_id", "m.n_words", "m.n_hit", "m.spans")


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` with no word in a benchmark window."""
    bounded_batches(docs.sparkSession)
    slices = broadcast_slices(benchmark, "item_id", "text")
    return docs.filter(matches(F.col("text"), slices, window)["n_hit"] == 0)
