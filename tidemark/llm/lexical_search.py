"""Ranked lexical search: Block-Max MaxScore over shards, shard heaps merged.

The index holds, per shard of documents and term, a list of postings in blocks: ordinals of
documents within the shard and the exact impact of the term in each, packed in as few bytes
as the shard's numbers need, with the largest impact and the last ordinal of each block beside
them. A score is the sum of weight times impact over an item's terms, in whole numbers.

A shard answers a block of items. Per item, lists are ordered by their global bound, weight
times the list's largest impact. Lists whose bounds together can't reach the lowest score
among the best so far are not essential: only documents of the others are candidates. Going
through the rest by falling bound, a candidate whose score so far, plus the maxima of the
blocks that it falls in, can't reach that score is rejected before those blocks are
unpacked. Documents are taken in windows of ordinals, after each of which that score rises.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import bounded_batches, stored, texts
from tidemark.llm.decontamination import words

K = 10
#: Bytes of text in one shard at most, or one longer text.
SHARD_BYTES = 16 << 20
#: Postings in a block, ordinals in a window, items in a block of queries.
POSTINGS = 128
ORDINALS = 2_048
ITEMS = 500
#: Terms in one Arrow batch of the index.
BATCH_TERMS = 20_000
#: Rows of query terms, with their items, that are broadcast; more meet the index by exchange.
BROADCAST_TERMS = 100_000

# As :func:`words` splits texts: runs of digits, letters and whatever is beyond ASCII.
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SCALE = 1_000_000_000


@dataclass(frozen=True)
class Index:
    """``postings(shard, term, df, bounds, lasts, steps, worth)``, ``shards(shard, ids)``,
    and the numbers of documents with a term and of all terms."""

    postings: DataFrame
    shards: DataFrame
    n_docs: int
    n_terms: int


def term_counts(docs: DataFrame) -> tuple[int, int]:
    """Documents with at least one term, and all terms of ``text``."""
    n = F.coalesce(F.regexp_count("text", F.lit(_TERM)), F.lit(0)).cast("long")
    found = docs.select(n.alias("n")).agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0)))
    return tuple(map(int, found.first()))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term of ``tf`` occurrences is worth in a document of ``n`` terms."""
    m = 25 + (75 * n * n_docs) // max(n_terms, 1)
    return (_SCALE * tf) // (1_000 * tf + 8 * m)


@dataclass(frozen=True)
class Lists:
    """The lists of a shard one after the other, packed in numbers of equal width.

    ``ends`` has the end of each list among the postings, ``block_ends`` among the blocks.
    ``steps`` go from one ordinal to the next within a block, the first from 0.
    """

    ends: np.ndarray
    block_ends: np.ndarray
    bounds: np.ndarray
    lasts: np.ndarray
    steps: np.ndarray
    worth: np.ndarray

    @property
    def columns(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """``bounds, lasts, steps, worth``, each with the ends of the lists in it."""
        by_block, by_posting = (self.bounds, self.lasts), (self.steps, self.worth)
        return [(x, self.block_ends) for x in by_block] + [(x, self.ends) for x in by_posting]


def narrow(numbers: np.ndarray) -> np.ndarray:
    """The numbers in the fewest bytes that hold the largest."""
    top = int(numbers.max()) if len(numbers) else 0
    return numbers.astype(next(f"<u{w}" for w in (1, 2, 4, 8) if top < 1 << 8 * w))


def packed(ordinals: np.ndarray, worth: np.ndarray, ends: np.ndarray) -> Lists:
    """Lists that end at ``ends``, in blocks of ``POSTINGS``."""
    n = np.diff(ends, prepend=0)
    blocks = -(-n // POSTINGS)
    block_ends = np.cumsum(blocks)
    within = np.arange(block_ends[-1]) - np.repeat(block_ends - blocks, blocks)
    first = np.repeat(ends - n, blocks) + POSTINGS * within
    steps = np.diff(ordinals, prepend=0)
    steps[first] = ordinals[first]
    last = np.append(first[1:], len(ordinals)) - 1
    return Lists(ends, block_ends, narrow(np.maximum.reduceat(worth, first)), narrow(ordinals[last]), narrow(steps), narrow(worth))


def as_binary(numbers: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of consecutive numbers, a value up to each end."""
    offsets = np.append(0, ends * numbers.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(numbers))])


def shard_lists(batch: list[bytes | None], n_docs: int, n_terms: int) -> tuple[list[bytes], Lists | None]:
    """The terms of a shard, whose documents are in order, and their lists."""
    known: dict[bytes, int] = defaultdict(itertools.count().__next__)  # terms are numbered as they come
    ids, lengths = [], np.zeros(len(batch), np.int64)
    for doc, text in enumerate(batch):
        held = words(text)
        lengths[doc] = len(held)
        ids.append(np.fromiter(map(known.__getitem__, held), np.int64, len(held)))
    if not known:
        return [], None
    pairs = np.concatenate(ids) * len(batch) + np.repeat(np.arange(len(batch)), lengths)
    pairs, tf = np.unique(pairs, return_counts=True)
    term, ordinal = np.divmod(pairs, len(batch))
    worth = impacts(tf.astype(np.int64), lengths[ordinal], n_docs, n_terms)
    ends = np.append(np.flatnonzero(np.diff(term)) + 1, len(term))
    return list(known), packed(ordinal, worth, ends)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.DataType, list[tuple]]]:
    """Consecutive documents, as id and text, of at most ``SHARD_BYTES``; and the type of ids."""
    held, size, kind = [], 0, pa.null()
    for batch in batches:
        kind = batch.schema.field(0).type
        for row in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
            n = len(row[1] or b"")
            if held and size + n > SHARD_BYTES:
                yield kind, held
                held, size = [], 0
            held.append(row)
            size += n
    if held:
        yield kind, held


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Index:
    """An index of every row of ``docs``, in shards that stay where their documents are.

    Null and empty texts have no terms and are never found. Rows that repeat an id are
    documents of their own. Within a shard documents are in the order of their ids, null
    first. Columns that are not named are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    n_docs, n_terms = term_counts(docs)
    id_type = docs.schema["doc_id"].dataType
    packed_columns = ("bounds", "lasts", "steps", "worth")
    schema = T.StructType(
        [
            T.StructField("shard", T.LongType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("term", T.BinaryType()),
            T.StructField("df", T.LongType()),
            *(T.StructField(c, T.BinaryType()) for c in packed_columns),
        ]
    )
    names = schema.names

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        for kind, held in _shards(batches):
            shard = next(numbers)
            held.sort(key=lambda row: (row[0] is not None, row[0]))
            none = [pa.nulls(1, t) for t in (pa.binary(), pa.int64(), *(pa.binary(),) * 4)]
            ids = pa.array([[i for i, _ in held]], pa.list_(kind))
            yield pa.RecordBatch.from_arrays([pa.array([shard]), ids, *none], names)
            terms, lists = shard_lists([t for _, t in held], n_docs, n_terms)
            if lists is None:
                continue
            columns = [
                pa.array(np.full(len(terms), shard)),
                pa.nulls(len(terms), pa.list_(kind)),
                pa.array(terms, pa.binary()),
                pa.array(np.diff(lists.ends, prepend=0)),
                *(as_binary(*c) for c in lists.columns),
            ]
            rows = pa.RecordBatch.from_arrays(columns, names)
            for at in range(0, len(terms), BATCH_TERMS):
                yield rows.slice(at, BATCH_TERMS)

    rows = stored(docs.mapInArrow(of, schema), "lexical-index")
    return Index(rows.filter("term is not null").drop("ids"), rows.filter("term is null").select("shard", "ids"), n_docs, n_terms)


class Postings:
    """One list of a shard, of which blocks are unpacked when they are asked for."""

    def __init__(self, weight: int, df: int, bounds: bytes, lasts: bytes, steps: bytes, worth: bytes):
        blocks = -(-df // POSTINGS)
        read = lambda x, n: np.frombuffer(x, f"<u{len(x) // n}")
        self.weight, self.steps, self.worth = weight, read(steps, df), read(worth, df)
        self.bounds, self.lasts = (read(x, blocks).astype(np.int64) for x in (bounds, lasts))
        self.bound = weight * int(self.bounds.max())
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ordinals and impacts."""
        if k not in self.open:
            own = slice(k * POSTINGS, (k + 1) * POSTINGS)
            self.open[k] = np.cumsum(self.steps[own].astype(np.int64)), self.worth[own].astype(np.int64)
        return self.open[k]

    def within(self, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ordinals from ``low`` up to ``high`` and their impacts, by block."""
        for k in range(int(np.searchsorted(self.lasts, low)), len(self.lasts)):
            ordinals, values = self.block(k)
            a, b = np.searchsorted(ordinals, (low, high))
            if b > a:
                yield ordinals[a:b], values[a:b]
            if self.lasts[k] >= high:
                break


def best(lists: list[tuple[int, Postings]], n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ordinals and scores of the ``k`` best of ``n`` documents, best first, ties by ordinal.

    ``lists`` has each term's occurrences in the item and its postings.
    """
    lists = sorted(((q * p.weight, p) for q, p in lists if p.weight), key=lambda x: -x[0] * int(x[1].bounds.max()))
    bounds = [w * int(p.bounds.max()) for w, p in lists]
    beyond = np.cumsum([0, *bounds[::-1]])[::-1]  # of the lists from each one on, together
    found, scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
    for low in range(0, n if lists else 0, ORDINALS):
        high = min(low + ORDINALS, n)
        essential = int(np.count_nonzero(beyond[:-1] >= least))
        if not essential:
            break
        total = np.zeros(high - low, np.int64)
        for w, p in lists[:essential]:
            for ordinals, values in p.within(low, high):
                total[ordinals - low] += w * values
        candidates = np.flatnonzero(total)
        for at in range(essential, len(lists)):
            if not len(candidates):
                break
            # What these could get at most, by the blocks that they fall in.
            most = total[candidates] + beyond[at + 1]
            w, p = lists[at]
            block = np.searchsorted(p.lasts, candidates + low)
            inside = block < len(p.lasts)
            most[inside] += w * p.bounds[block[inside]]
            stay = most >= least
            candidates, block, inside = candidates[stay], block[stay], inside[stay]
            for b in np.unique(block[inside]).tolist():
                ordinals, values = p.block(b)
                mine = candidates[block == b]
                place = np.minimum(np.searchsorted(ordinals, mine + low), len(ordinals) - 1)
                hit = ordinals[place] == mine + low
                total[mine[hit]] += w * values[place[hit]]
        candidates = candidates[total[candidates] >= least]
        found, scores = np.append(found, candidates + low), np.append(scores, total[candidates])
        if len(found) > k:
            keep = np.lexsort((found, -scores))[:k]
            found, scores = found[keep], scores[keep]
        if len(found) == k:
            # An equal score further on has a later ordinal, but may have an equal id elsewhere.
            least = max(1, int(scores.min()))
    order = np.lexsort((found, -scores))
    return found[order], scores[order]


def query_terms(items: DataFrame, index: Index) -> DataFrame:
    """``block, term, weight, items`` of ``item, text``: which items of a block ask for a term, how often."""
    bounded_batches(items.sparkSession)
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("term", T.BinaryType()), T.StructField("asked", T.LongType())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                counts: dict[bytes, int] = {}
                for w in words(text):
                    counts[w] = counts.get(w, 0) + 1
                if counts:
                    columns = [item] * len(counts), list(counts), list(counts.values())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.int64()))], schema.names)

    asked = stored(items.select("item", "text").mapInArrow(of, schema), "lexical-asked")
    known = index.postings.select("term", "df").join(asked.select("term").distinct(), "term", "left_semi")
    df = known.groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1_000 * F.log(F.lit(2.0 * index.n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = df.select("term", weight.alias("weight"))
    held = asked.groupBy(F.expr(f"item div {ITEMS}").alias("block"), "term").agg(F.collect_list(F.struct("item", "asked")).alias("items"))
    return held.join(weights, "term").select("block", "term", "weight", "items")


def search(index: Index, items: DataFrame, k: int = K, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents that score highest for each item.

    Scores are above 0, ranks count from 1 without a gap, equal scores go to the smaller
    ``doc_id``, null first; documents that repeat an id each have their rank. Fewer documents
    than ``k`` with a score are all returned. A null text, or one whose terms no document
    has, finds nothing. Rows equal in id and text are one item; rows that share an id with
    different texts are ranked each on its own.
    """
    items = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).filter("text is not null").distinct()
    # Consecutive numbers, so that a block of items is full.
    items = stored(items.withColumn("at", F.monotonically_increasing_id()), "lexical-items")
    parts = stored(items.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")), "lexical-parts")
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per task that wrote items.
    shift = F.broadcast(parts.select("part", before.alias("shift")))
    numbered = items.withColumn("part", F.shiftright("at", 33)).join(shift, "part")
    numbered = stored(numbered.select((F.col("shift") + F.col("at") % (1 << 33)).alias("item"), "item_id", "text"), "lexical-items")
    asked = stored(query_terms(numbered, index), "lexical-terms")
    n_asked = asked.agg(F.coalesce(F.sum(F.size("items")), F.lit(0))).first()[0]
    lists = index.postings.join(F.broadcast(asked) if n_asked <= BROADCAST_TERMS else asked, "term")
    ids = lists.select("shard", "block").distinct().join(index.shards, "shard")
    columns = ["shard", "block", "ids", "weight", "items", "df", "bounds", "lasts", "steps", "worth"]
    filled = lambda df: df.select(
        *(F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in columns)
    )
    types = {f.name: f.dataType for f in (*asked.schema, *index.postings.schema, *index.shards.schema)}
    groups = filled(lists).unionByName(filled(ids)).groupBy("shard", "block")
    schema = T.StructType(
        [T.StructField("item", T.LongType()), T.StructField("doc_id", types["ids"].elementType), T.StructField("score", T.LongType())]
    )

    def of(group: pa.Table) -> pa.Table:
        ids, wanted = [], {}
        for row in group.drop_columns(["shard", "block"]).to_pylist():
            if row["ids"] is not None:
                ids = row["ids"]
                continue
            postings = Postings(row["weight"], *(row[c] for c in columns[5:]))
            for one in row["items"]:
                wanted.setdefault(one["item"], []).append((one["asked"], postings))
        out = [[], [], []]
        for item, held in wanted.items():
            ordinals, scores = best(held, len(ids), k)
            out[0] += [item] * len(ordinals)
            out[1] += [ids[o] for o in ordinals.tolist()]
            out[2] += scores.tolist()
        arrow = group.schema.field("ids").type.value_type
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), arrow, pa.int64()))], names=schema.names)

    heaps = groups.applyInArrow(of, schema)
    # Heaps hold k rows of an item at most, of which k stay; Spark merges them within tasks first.
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
    merged = heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = numbered.select("item", "item_id")
    return merged.join(names, "item").select("item_id", "rank", "doc_id", "score")
