"""Prefix trie of conversations by fixed-length block hashing.

1. Turns are numbered by one sort over all of them, so no conversation is gathered anywhere.
2. Every ``BLOCK`` turns make a block. A turn's hash holds its place, and a prefix's digest is
   the sum of its turns' hashes, so digests of blocks and of all that precedes them come from
   sums. Conversations with the same digest at their end are one sequence, which its smallest
   conversation stands for; only these go on.
3. Sequences are grouped by their digests block by block. A block without a sibling is one
   path: its nodes have the members of the block.
4. Only inside blocks that diverge from a sibling are turns compared: each different block
   is unfolded once, however many conversations hold it, and its turns' prefixes are grouped.
5. What a subtree sums up is a sum over the members of its top: of whole lengths, and of what
   each sequence is the first to hold. No step walks from depth to depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import bounded_batches, stored
from tidemark.operators.running import running

#: Turns in a block.
BLOCK = 4
#: Decimal ids joined in one piece.
PIECE = 1_000
#: Parents with more than a ``HOT``-th of all nodes are broadcast: fewer than ``HOT`` of them.
HOT = 10_000
_WIDE = "decimal(38,0)"
_PARTITION_BITS = 33  # of a monotonically increasing id: the rows of a partition


def _hash(*columns: str | Column) -> list[Column]:
    """128 bits of the columns, as two numbers that can be summed up."""
    return [F.xxhash64(F.lit(k), *columns) for k in (1, 2)]


def numbered(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, h1, h2, bytes`` of ``conv_id, turn, role, text``: turns in their order.

    Turns of a conversation are in the order of ``turn``, null first; of equal ones in that of
    role and text. A null role or text counts as empty. Turns without a conversation's id
    belong to none and are left out.
    """
    filled = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text"))
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = filled.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    h1, h2 = _hash("role", "text")
    rows = sorted_.select(
        "conv_id",
        F.monotonically_increasing_id().alias("at"),
        h1.alias("h1"),
        h2.alias("h2"),
        F.octet_length("text").cast("long").alias("bytes"),
    )
    rows = stored(rows, "turns").withColumn("part", F.shiftright("at", _PARTITION_BITS))
    # A conversation that goes on in the next partition goes on counting there.
    held = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return rows.join(held, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("shift")).alias("pos"), "h1", "h2", "bytes")


def _blocks(turns: DataFrame) -> DataFrame:
    """``conv_id, block, n, s1, s2, size, turns``: sums of a block, and its turns in order."""
    t1, t2 = _hash("pos", "h1", "h2")
    terms = turns.select("conv_id", "pos", t1.alias("t1"), t2.alias("t2"), "bytes")
    return terms.groupBy("conv_id", F.expr(f"pos div {BLOCK}").alias("block")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("t1").cast(_WIDE)).alias("s1"),
        F.sum(F.col("t2").cast(_WIDE)).alias("s2"),
        F.sum("bytes").alias("size"),
        F.array_sort(F.collect_list(F.struct("pos", "t1", "t2", "bytes"))).alias("turns"),
    )


def _sequences(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """``conv_id, depth, d1, d2, size`` of every conversation: its whole length and digest."""
    whole = blocks.groupBy("conv_id").agg(
        F.sum("n").alias("depth"), F.sum("s1").cast(_WIDE).alias("d1"), F.sum("s2").cast(_WIDE).alias("d2"), F.sum("size").alias("size")
    )
    filled = {c: F.coalesce(c, F.lit(0).cast(_WIDE if c in ("d1", "d2") else "long")) for c in ("depth", "d1", "d2", "size")}
    return convs.select("conv_id").distinct().join(whole, "conv_id", "left").withColumns(filled)


def _unfolded(blocks: DataFrame, *more: str) -> DataFrame:
    """One row per turn of each block: ``depth``, its prefix's digest, its parent's, bytes before."""
    upto = lambda name, j: F.aggregate(
        F.slice("turns", 1, j), F.lit(0).cast(_WIDE), lambda total, t: (total + t[name].cast(_WIDE)).cast(_WIDE)
    )
    at = lambda name, before, j: (F.col(before) + upto(name, j)).cast(_WIDE)
    earlier = lambda j: F.aggregate(F.slice("turns", 1, j), F.lit(0).cast("long"), lambda total, t: total + t["bytes"])
    node = lambda t, j: F.struct(
        (t["pos"] + 1).alias("depth"),
        at("t1", "p1", j + 1).alias("d1"),
        at("t2", "p2", j + 1).alias("d2"),
        at("t1", "p1", j).alias("u1"),
        at("t2", "p2", j).alias("u2"),
        t["bytes"].alias("bytes"),
        (F.col("before") + earlier(j)).alias("above"),
    )
    return blocks.select(*more, F.inline(F.transform("turns", node)))


def _with_parent(nodes: DataFrame, parents: DataFrame, total: int) -> DataFrame:
    """``nodes`` with ``parent_conv_id``; a parent of very many children doesn't take them to one task."""
    keys = ["depth", "u1", "u2"]
    named = parents.select(
        (F.col("depth") + 1).alias("depth"), F.col("d1").alias("u1"), F.col("d2").alias("u2"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    hot = F.col("n_children") * HOT > total
    many = stored(named.filter(hot), "hot-parents")
    few = named.filter(~hot).drop("n_children")
    many = F.broadcast(many.drop("n_children"))
    of_many = nodes.join(many, keys)
    return of_many.unionByName(nodes.join(many, keys, "left_anti").join(few, keys, "left"))


def _ends(sequences: DataFrame) -> DataFrame:
    """``depth, d1, d2, ends_sha256`` over the conversations that end in a node.

    Ids are sorted and joined in pieces by all tasks. The digest itself takes one node's
    pieces in their order, as a stream.
    """
    bounded_batches(sequences.sparkSession)
    keys = ["depth", "d1", "d2"]
    parts = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    node = [F.col("depth"), F.col("d1").cast("string").alias("d1"), F.col("d2").cast("string").alias("d2")]
    order = [*keys, "conv_id"]
    ids = sequences.select(*node, "conv_id").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = "depth long, d1 string, d2 string, conv_id long, ids string"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, done = None, [], []
        for batch in batches:
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (key != now or len(held) == PIECE):
                    done.append((*now, held[0], ",".join(map(str, held))))
                    held = []
                now = key
                held.append(conv)
            if done:
                yield _rows(done, _PIECES)
                done = []
        if held:
            yield _rows([(*now, held[0], ",".join(map(str, held)))], _PIECES)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []
        for batch in batches:
            for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = key, hashlib.sha256(ids.encode())
            if done:
                yield _rows(done, _DIGESTS)
                done = []
        if now is not None:
            yield _rows([(*now, state.hexdigest())], _DIGESTS)

    joined = ids.mapInArrow(pieces, schema).repartition(parts, *keys).sortWithinPartitions(*order)
    found = joined.mapInArrow(digests, "depth long, d1 string, d2 string, ends_sha256 string")
    return found.withColumns({c: F.col(c).cast(_WIDE) for c in ("d1", "d2")})


_NODE = [("depth", pa.int64()), ("d1", pa.string()), ("d2", pa.string())]
_PIECES = pa.schema([*_NODE, ("conv_id", pa.int64()), ("ids", pa.string())])
_DIGESTS = pa.schema([*_NODE, ("ends_sha256", pa.string())])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def prefix_trie(turns: DataFrame, convs: DataFrame, target: int | None = None) -> DataFrame:
    """One row per node of the trie of ``turns(conv_id, pos, h1, h2, bytes)``.

    ``pos`` counts a conversation's turns from 0 without a gap; ``convs`` has the ids of all
    conversations, also of those without a turn, as often as it likes. Ids are long. A
    conversation that isn't in ``convs`` has no part. Returns ``conv_id`` (the smallest
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``. Without conversations there is no node. ``target``
    is the number of blocks that one task may scan, as :func:`running` knows it.
    """
    keys = ["depth", "d1", "d2"]
    blocks = stored(_blocks(turns), "trie-blocks")
    sequences = stored(_sequences(blocks, convs), "trie-sequences")
    distinct = sequences.groupBy(*keys).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"), F.min("size").alias("whole"))
    distinct = stored(distinct, "trie-distinct")
    mine = distinct.select("conv_id", F.col("n").alias("convs"), "whole")
    # Blocks of the sequences, each with what precedes it.
    sums = running(
        blocks.join(mine.select("conv_id"), "conv_id", "left_semi"),
        ["conv_id"],
        "block",
        {"a1": ("sum", "s1"), "a2": ("sum", "s2"), "after": ("sum", "size")},
        target=target,
    )
    paths = sums.join(mine, "conv_id").select(
        "conv_id",
        "block",
        "convs",
        "whole",
        "turns",
        *(F.col(f"a{k}").cast(_WIDE).alias(f"b{k}") for k in (1, 2)),
        *((F.col(f"a{k}") - F.col(f"s{k}")).cast(_WIDE).alias(f"p{k}") for k in (1, 2)),
        (F.col("after") - F.col("size")).alias("before"),
    )
    paths = stored(paths, "trie-paths")
    own = ["block", "b1", "b2"]
    held = paths.groupBy(*own).agg(F.min("conv_id").alias("conv_id"), F.sum("convs").alias("n_convs"))
    # A block is held by its smallest sequence, which has the turns.
    held = paths.select(*own, "conv_id", "turns", "p1", "p2", "before").join(held, [*own, "conv_id"])
    siblings = held.groupBy("block", "p1", "p2").agg((F.count(F.lit(1)) > 1).alias("diverges"))
    held = stored(held.join(siblings, ["block", "p1", "p2"]), "trie-held")
    each = stored(_unfolded(held, *own, "diverges", "conv_id", "n_convs"), "trie-unfolded")
    by = [*keys, "u1", "u2", "bytes", "above"]
    apart = each.filter("diverges").groupBy(*by).agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"))
    nodes = each.filter("not diverges").select(*by, "conv_id", "n_convs").unionByName(apart)
    zero = F.lit(0).cast(_WIDE)
    root = distinct.agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs")).filter("n_convs is not null")
    root = root.select(
        *(F.lit(0).cast("long").alias(c) for c in ("depth", "bytes", "above")), *(zero.alias(c) for c in ("d1", "d2", "u1", "u2")), "conv_id", "n_convs"
    )
    nodes = nodes.unionByName(root)
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("u1").alias("d1"), F.col("u2").alias("d2"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, keys, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stored(nodes, "trie-nodes")

    # What a sequence is the first to hold: bytes of its own nodes, and its end if it is a leaf.
    first = nodes.groupBy("conv_id").agg(F.sum("bytes").alias("own"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    weights = mine.join(first, "conv_id", "left").select(
        "conv_id", (F.col("convs") * F.col("whole")).alias("all"), "whole", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("own", "leaf"))
    )
    weights = stored(weights, "trie-weights")
    sums_of = lambda: (
        F.sum("all").alias("all"),
        F.sum("own").alias("own"),
        F.sum("leaf").alias("leaf"),
        F.min(F.struct("conv_id", "own_first", "whole")).alias("top"),
    )
    one = weights.withColumn("own_first", F.col("own"))
    of_block = paths.select("conv_id", *own).join(one, "conv_id").groupBy(*own).agg(*sums_of())
    of_block = of_block.select(*own, "all", "own", "leaf", "top.conv_id", "top.own_first", "top.whole")
    # Blocks' sums go to their turns, and turns that several blocks share are put together.
    of_turn = each.select(*own, "diverges", *keys).join(of_block, own)
    merged = of_turn.filter("diverges").groupBy(*keys).agg(*sums_of()).select(*keys, "all", "own", "leaf", "top.own_first", "top.whole")
    summed = of_turn.filter("not diverges").select(merged.columns).unionByName(merged)
    top = one.agg(*sums_of()).filter("top is not null").select("all", "own", "leaf", "top.own_first", "top.whole")
    summed = summed.unionByName(top.select(F.lit(0).cast("long").alias("depth"), zero.alias("d1"), zero.alias("d2"), "*"))
    # All turns of all members from here on, without the first of each: (members' lengths
    # less what precedes) less (the turns that differ).
    nodes = nodes.join(summed, keys)
    gathered = F.col("all") - F.col("n_convs") * F.col("above")
    differing = F.col("own") - F.col("own_first") + F.col("whole") - F.col("above")
    nodes = nodes.select("conv_id", *keys, "u1", "u2", "n_convs", "n_children", F.col("leaf").alias("n_leaves"), (gathered - differing).alias("saved_tokens"))
    nodes = stored(nodes.join(_ends(sequences), keys, "left"), "trie-summed")
    nodes = _with_parent(nodes, nodes, nodes.count())
    return nodes.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def rebuilt(turns: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like others: ``conv_id, pos, h1, h2, bytes``, and all ids.

    Conversation c takes the first h turns of conversation c - c % family, h being crc32 of
    c's decimal modulo ``most``, and then its own without the first h. ``turns`` is what
    :func:`numbered` gives.
    """
    count = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    plan = count.select("conv_id", (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    bases = count.select(F.col("conv_id").alias("base"), "n")
    plan = plan.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("n", F.lit(0)))).drop("n")
    plan = stored(plan, "trie-plan")
    heads = turns.filter(F.col("pos") < most - 1).withColumnRenamed("conv_id", "base")
    heads = heads.join(plan, "base").filter("pos < taken").select("conv_id", "pos", "h1", "h2", "bytes")
    own = turns.join(plan, "conv_id").filter("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "h1", "h2", "bytes")
    return heads.unionByName(own), plan.select("conv_id")
