"""Near-duplicates by MinHash: many universal hash minima, bands, signatures, components.

1. Every text becomes its set of word shingles as 64-bit hashes, a fingerprint of the set,
   the minima of the set under many universal hash functions, and a key per band of minima.
2. Texts with equal sets are one class, which has a number of its own. Ids only name results;
   classes that hold the same id are linked by it.
3. Classes that share a band key are in a bucket. A bucket emits no pairs within: its members
   are compared with the one that shares most buckets. Pairs must agree in their signatures
   before their full sets are compared. Components follow by alternating large-star and
   small-star.
4. In buckets that still hold several components, members are compared with one drawn by a
   hash, of another component than theirs.
5. Where a bucket then still holds several, its members go to an exact join. Two linked sets
   of n and m shingles share at least o = 75 (n + m) / 175, so in any common order of all
   shingles, here from rare to frequent, they share one of the first n - o + 1 of the one and
   the first m - o + 1 of the other. Only these meet, only where their components differ,
   and only if each is early enough for the sizes of both. Texts that share a template but
   too little else meet nowhere, as their own shingles come first.

A linked pair at the threshold shares no band with a chance of (1 - 0.75^5)^40, one in
50,000, and a component usually has more than one link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import SMALL_BATCH_BYTES, as_lists, bounded_batches, stored, texts, unlike
from tidemark.llm.components import components

SHINGLE = 5
#: Sets are linked if 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75
BANDS = 40
ROWS = 5
SEED = 20_240_229
#: Least share of equal minima for comparing full sets: at a similarity of 0.75 and 200
#: minima, six standard deviations below what is expected.
SIGNATURE_SHARE = 0.56
#: Shingles whose minima are taken at once; bounds the memory for texts of any length.
BLOCK = 1_024
#: Ids of documents to compare are broadcast up to so many of them, and bytes with their
#: fingerprints; more are joined by an exchange of the texts.
BROADCAST_IDS = 1_000_000
BROADCAST_BYTES = 64 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of shingles of texts, as sorted 64-bit hashes."""

    def __init__(self, size: int = SHINGLE):
        self.size = size

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()  # of bytes: A-Z, and the six ASCII blanks
        if not words:
            return np.zeros(0, np.uint64)
        known = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(words))
        n = len(words) - size + 1
        total = np.full(n, np.uint64(size))
        for k in range(size):
            total = _mixed(total * _MIX + h[k : k + n])
        return np.unique(total)


class Minima:
    """Minima of sets under universal hash functions ax + b modulo 2^64, upper half."""

    def __init__(self, n: int, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.a = draw.integers(0, 1 << 63, n, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
        self.b = draw.integers(0, 1 << 63, n, np.uint64)[:, None] * np.uint64(2)
        self.work = np.empty((n, BLOCK), np.uint64)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), np.iinfo(np.uint64).max)
        for at in range(0, len(shingles), BLOCK):
            x = shingles[at : at + BLOCK]
            work = self.work[:, : len(x)]
            np.multiply(self.a, x, out=work)
            np.add(work, self.b, out=work)
            np.minimum(least, work.min(axis=1), out=least)
        return (least >> np.uint64(32)).astype(np.uint32)


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, print, signature, keys`` of ``doc_id, text``.

    The signature is one byte of each minimum; keys are hashes of a band's minima. Rows of
    an empty set have none of the three.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, minima = Shingler(), Minima(bands * rows)
        band = np.arange(bands, dtype=np.uint64) * _MIX
        for batch in batches:
            sizes, prints, signatures, keys = [], [], [], []
            for text in texts(batch.column(1)):
                found = shingle(text)
                sizes.append(len(found))
                if not len(found):
                    for out in (prints, signatures, keys):
                        out.append(None)
                    continue
                prints.append(xxhash.xxh3_128_digest(found.tobytes()))
                least = minima(found)
                signatures.append(least.astype(np.uint8).tobytes())
                key = band.copy()
                for row in least.reshape(bands, rows).T.astype(np.uint64):
                    key = _mixed(key * _MIX + row)
                keys.append(key.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.array(signatures, pa.binary()),
                    as_lists(keys, "<i8"),
                ],
                ["doc_id", "n_shingles", "print", "signature", "keys"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_shingles long, print binary, signature binary, keys array<long>"
    return docs.select("doc_id", "text").mapInArrow(of, schema)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, print, shingles`` with the full sets."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler()
        for batch in batches:
            sets = [shingle(t).tobytes() for t in texts(batch.column(1))]
            prints = pa.array([xxhash.xxh3_128_digest(s) if s else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), prints, as_lists(sets, "<i8")], ["doc_id", "print", "shingles"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(of, f"doc_id {id_type}, print binary, shingles array<long>")


def set_print(text: Column) -> Column:
    """The fingerprint of a text's set; null where that is empty."""

    @F.arrow_udf("binary")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        shingle = Shingler()
        for batch in batches:
            sets = (shingle(t).tobytes() for t in texts(batch))
            yield pa.array([xxhash.xxh3_128_digest(s) if s else None for s in sets], pa.binary())

    return of(text)


def agreement(one: Column, other: Column) -> Column:
    """Number of equal bytes of two signatures."""

    @F.arrow_udf("int")
    def equal(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(len(c), -1) for c in (a, b))
        return pa.array((x == y).sum(axis=1).astype(np.int32))

    return equal(one, other)


def _sizes_allow(one: str, other: str) -> Column:
    return 100 * F.least(one, other) >= SIMILARITY * F.greatest(one, other)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs(u, v)`` whose full sets are similar enough."""
    one = sets.select(F.col("node").alias("u"), F.col("shingles").alias("s"))
    other = sets.select(F.col("node").alias("v"), F.col("shingles").alias("t"))
    both = pairs.join(one, "u").join(other, "v")
    common = F.size(F.array_intersect("s", "t"))
    return both.filter(100 * common >= SIMILARITY * (F.size("s") + F.size("t") - common)).select("u", "v")


def _buckets(members: DataFrame) -> DataFrame:
    """``band, key, node, m``: the nodes of buckets of several, and how many those are."""
    sizes = members.groupBy("band", "key").agg(F.count("*").alias("m")).filter("m > 1")
    return members.join(sizes, ["band", "key"])


def _central_pairs(buckets: DataFrame) -> DataFrame:
    """Each member with the one that shares most buckets, counted with their sizes.

    That one is nearest to the origin of a group of copies, and mostly the same for all
    buckets of a group.
    """
    weight = buckets.groupBy("node").agg(F.sum("m").alias("w"))
    central = (
        buckets.join(weight, "node").groupBy("band", "key").agg(F.max_by("node", F.struct("w", "node")).alias("v"))
    )
    return buckets.join(central, ["band", "key"]).select("node", "v")


def _drawn_pairs(mixed: DataFrame) -> DataFrame:
    """Each member with one drawn by a hash, where the two are of different components."""
    who = F.struct(F.col("node").alias("v"), F.col("label").alias("label_v"))
    drawn = mixed.groupBy("band", "key").agg(F.min_by(who, F.xxhash64("node", "key")).alias("hub"))
    both = mixed.join(drawn, ["band", "key"]).select("node", "label", "hub.v", "hub.label_v")
    return both.filter("label != label_v").select("node", "v")


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of ``pairs(u, v)`` that their sizes and signatures allow to be links."""
    for name in ("u", "v"):
        side = classes.select(
            F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("signature").alias(f"s_{name}")
        )
        pairs = pairs.join(side, name)
    likely = pairs.filter(_sizes_allow("n_u", "n_v"))
    likely = likely.filter(agreement(F.col("s_u"), F.col("s_v")) >= int(SIGNATURE_SHARE * BANDS * ROWS))
    return stored(likely.select("u", "v"), "likely-pairs")


def _compared(pairs: DataFrame, docs: Texts) -> DataFrame:
    """Links ``u, v`` among ``pairs(node, v)``: by sizes, signatures, then full sets."""
    pairs = pairs.filter("node != v").select(F.greatest("node", "v").alias("u"), F.least("node", "v").alias("v"))
    likely = _likely(pairs.distinct(), docs.classes)
    sets = docs.sets(likely.select("u").unionAll(likely.select("v")))
    return stored(_verified(likely, sets), "links")


def link(docs: Texts, known: DataFrame | None = None) -> DataFrame:
    """``node, component`` for classes with links; ``known(u, v)`` are links besides."""
    members = docs.classes.select("node", F.posexplode("keys").alias("band", "key"))
    buckets = stored(_buckets(members), "buckets")
    links = _compared(_central_pairs(buckets), docs)
    if known is not None:
        links = stored(links.unionByName(known), "links")
    labels = stored(components(links), "labels")
    # In a bucket of two, the pair itself has been compared.
    mixed = _undecided(buckets.filter("m > 2").select("band", "key", "node"), labels)
    if mixed.isEmpty():
        return labels
    links = links.unionAll(_compared(_drawn_pairs(mixed), docs))
    labels = stored(components(links), "labels")
    mixed = _undecided(mixed.select("band", "key", "node"), labels)
    if mixed.isEmpty():
        return labels
    return components(links.unionAll(_exact_links(docs, mixed.select("node", "label").distinct())))


def _undecided(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """``band, key, node, label`` of the buckets that hold several components."""
    rows = buckets.join(labels, "node", "left")
    rows = rows.select("band", "key", "node", F.coalesce("component", "node").alias("label"))
    several = rows.groupBy("band", "key").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a != b")
    return stored(rows.join(several, ["band", "key"], "left_semi"), "mixed-buckets")


def _sent(rows: DataFrame, ids: str) -> Callable[[DataFrame], DataFrame]:
    """How to join texts to stored ``rows`` by ``ids``: sent to them, or an exchange where there are too many."""
    size = F.coalesce(F.sum(F.coalesce(F.octet_length(F.col(ids).cast("string")), F.lit(0)) + 40), F.lit(0))
    n, total = rows.agg(F.count(F.lit(1)), size).first()
    return F.broadcast if n <= BROADCAST_IDS and total <= BROADCAST_BYTES else lambda df: df


@dataclass(frozen=True)
class Texts:
    """Documents, and the classes of their sets: ``node, print, least, n_shingles, signature, keys``."""

    docs: DataFrame
    classes: DataFrame
    repeats: bool  # whether an id, or null, may come more than once

    def sets(self, nodes: DataFrame) -> DataFrame:
        """``node, shingles`` of some classes. Texts stay where they are if the ids are few enough."""
        wanted = stored(self.classes.join(nodes.toDF("node").distinct(), "node").select("node", "print", "least"), "wanted")
        sent = _sent(wanted, "least")
        of_ids = self.docs.join(sent(wanted.select("least")), F.col("doc_id").eqNullSafe(F.col("least")), "left_semi")
        sets = shingle_sets(of_ids).join(sent(wanted.select("node", "print")), "print").select("node", "shingles")
        if self.repeats:
            sets = sets.dropDuplicates(["node"])
        return stored(sets, "shingle-sets")


def _needed(n: Column | str, m: Column | str) -> Column:
    """The least number of shingles that linked sets of these sizes share."""
    n, m = (F.col(c) if isinstance(c, str) else c for c in (n, m))
    return F.ceil(SIMILARITY * (n + m) / (100 + SIMILARITY)).cast("long")


def exact_pairs(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """``u, v`` of different labels that share one of the shingles by which links are found.

    ``sets(node, shingles)`` and ``labels(node, label)``. The longer set of a pair offers its
    rarest quarter, the shorter one its rarest seventh. Where a shingle is offered by many of
    one label, these meet only the others' nodes, not each other.
    """
    rows = sets.join(labels, "node").select("node", "label", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("s"))
    counts = rows.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    order = Window.partitionBy("node").orderBy("df", "s")
    ranked = rows.join(counts, "s").withColumn("r", F.row_number().over(order).cast("long"))
    # A set at least three quarters as large is the least that can be linked with one of n.
    first = F.col("n") - F.ceil(F.col("n") * SIMILARITY / 100).cast("long") + 1
    offered = stored(ranked.filter((F.col("r") <= first) & (F.col("df") > 1)).drop("df"), "offered")
    # Per shingle: the label that offers it most, and whether there is another at all.
    by_label = offered.groupBy("s", "label").agg(F.count(F.lit(1)).alias("c"))
    main = by_label.groupBy("s").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count(F.lit(1)).alias("labels"))
    offered = offered.join(main.filter("labels > 1").select("s", "main"), "s").withColumn("other", F.col("label") != F.col("main"))
    offered = stored(offered.drop("main"), "offered")
    short = offered.filter(F.col("r") <= F.col("n") - _needed("n", "n") + 1)
    short = short.select("s", *(F.col(c).alias(f"{c}_2") for c in ("node", "label", "n", "r", "other")))
    fits = (F.col("n_2") < F.col("n")) | ((F.col("n_2") == F.col("n")) & (F.col("node") != F.col("node_2")))
    o = _needed("n", "n_2")
    fits = fits & (F.col("label") != F.col("label_2")) & (F.col("r") <= F.col("n") - o + 1) & (F.col("r_2") <= F.col("n_2") - o + 1)
    pairs = offered.filter("other").join(short, "s").filter(fits)
    pairs = pairs.unionByName(offered.filter("not other").join(short.filter("other_2"), "s").filter(fits))
    return pairs.select(F.greatest("node", "node_2").alias("u"), F.least("node", "node_2").alias("v")).distinct()


def _exact_links(docs: Texts, rest: DataFrame) -> DataFrame:
    """All links between nodes of different labels, by the rarest shingles of each set."""
    sets = docs.sets(rest.select("node"))
    return stored(_verified(_likely(exact_pairs(sets, rest), docs.classes), sets), "links")


def _shared_ids(sketch: DataFrame, classes: DataFrame) -> tuple[DataFrame | None, bool]:
    """Links ``u, v`` between classes that hold the same id, and whether any id comes again."""
    rows = sketch.select("doc_id", F.xxhash64("print").alias("p"), "print")
    again = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("p").alias("lo"), F.max("p").alias("hi"))
    again = stored(again.filter("n > 1").drop("n"), "repeated-ids")
    if again.isEmpty():
        return None, False
    several = again.filter("doc_id is not null and lo != hi").select("doc_id")
    held = rows.filter("print is not null").join(several, "doc_id").select("doc_id", "print").distinct()
    held = held.join(classes.select("print", "node"), "print").select("doc_id", "node")
    first = held.groupBy("doc_id").agg(F.min("node").alias("v"))
    return held.join(first, "doc_id").select(F.col("node").alias("u"), "v").filter("u != v").distinct(), True


def classified(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, print, component, least_id`` of every row of ``docs(doc_id, text)``.

    ``component`` tells components apart, ``least_id`` is the smallest id in one, or null if
    none of its rows has an id. Both are null where the set is empty.
    """
    sketch = stored(sketches(docs), "sketches")
    one = sketch.filter("print is not null").groupBy("print")
    one = one.agg(F.min("doc_id").alias("least"), *(F.any_value(c).alias(c) for c in ("n_shingles", "signature", "keys")))
    classes = stored(one.withColumn("node", F.monotonically_increasing_id()), "classes")
    known, repeats = _shared_ids(sketch, classes)
    labels = stored(link(Texts(docs, classes, repeats), known), "labels")
    labelled = classes.select("node", "print", "least").join(labels, "node", "left")
    labelled = labelled.select("print", "least", F.coalesce("component", "node").alias("component"))
    names = labelled.groupBy("component").agg(F.min("least").alias("least_id"))
    labelled = stored(labelled.drop("least").join(names, "component"), "labelled")
    return sketch.select("doc_id", "n_shingles", "print").join(labelled, "print", "left")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Null and blank texts have an empty set, are linked with nothing and kept. A row without
    an id can't be named by others; its component is null and it is kept here, though it
    counts as a copy of others in :func:`keep_one`. Rows that repeat an id count as linked,
    whatever their texts, and come out one by one. An empty table gives no rows. Columns
    that are not named are not read.
    """
    bounded_batches(docs.sparkSession, SMALL_BATCH_BYTES)
    out = classified(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    component = F.when(F.col("n_shingles") > 0, F.col("least_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component: one of its smallest id.

    Rows with null or blank texts are linked with nothing and stay, but of those that share
    an id one does. Where no row of a component has an id, one of its rows stays; which of
    several with the same id is not fixed. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession, SMALL_BATCH_BYTES)
    rows = stored(classified(docs.select("doc_id", "text")), "classified")
    again = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null")
    again = stored(again.select(F.col("doc_id").alias("_again")), "repeated-ids")
    winner = F.when(F.col("n_shingles") > 0, F.col("doc_id").eqNullSafe(F.col("least_id"))).otherwise(True)
    gone = stored(rows.filter(~winner).select(F.col("doc_id").alias("_gone")).distinct(), "gone-ids")
    # Left to Spark's estimate, all texts would be exchanged from some 20,000 ids on.
    gone, again = _sent(gone, "_gone")(gone), _sent(again, "_again")(again)
    single = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_gone")), "left_anti")
    if again.isEmpty():
        return single.select(*docs.columns)
    same = F.col("doc_id").eqNullSafe(F.col("_again"))
    single = docs.filter("doc_id is not null").join(gone, F.col("doc_id") == F.col("_gone"), "left_anti").join(again, same, "left_anti")
    # Ids that come again, and rows without one, are told apart by what their texts hold.
    several = docs.join(again, same, "left_semi")
    mark = unlike(docs, "mark")
    several = several.withColumn(mark, F.struct("doc_id", F.coalesce(set_print(F.col("text")), F.lit(b"")).alias("print")))
    marks = rows.filter(winner).join(again, same, "left_semi")
    # One print of each id that wins for its component, and of nameless ones one per component.
    chosen = marks.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.coalesce("print", F.lit(b""))).alias("print"))
    lone = marks.filter("doc_id is null and print is not null").groupBy("component").agg(F.min("print").alias("print"))
    lone = lone.select(F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "print")
    chosen = chosen.unionByName(lone).select(F.struct("doc_id", "print").alias("_mark"))
    empty = several.filter(F.col("doc_id").isNull() & (F.col(mark)["print"] == F.lit(b"")))
    several = several.join(chosen, F.col(mark).eqNullSafe(F.col("_mark")), "left_semi").dropDuplicates([mark])
    return single.select(*docs.columns).unionByName(several.select(*docs.columns)).unionByName(empty.select(*docs.columns))
