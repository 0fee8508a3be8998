"""Approximate nearest neighbours: one navigable small-world graph per shard.

Distinct vectors are dealt out to shards by a hash. A shard's graph has levels: every
vector is on level 0, one in ``LINKS`` of those on a level is on the next. A vector is
linked to near ones in different directions, both ways. Links are kept as flat arrays of
neighbour positions, a fixed number per vector and level, one row per shard.

A search walks down from the highest level with a list of the best vectors found, on all
queries of a block at once. Each shard answers every query; the answers are merged, and
scored on the original vectors. The nearness is the inner product: vectors get one more
component that makes all norms equal, so that the largest product is the smallest angle.

Equal vectors are one vector of the graph with the smallest ids that have it, which is all
that an answer can need; a vector that a third of all rows share costs what one row does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored

#: Links per vector above level 0; twice as many on it.
LINKS = 16
BUILD_WIDTH = 80
SEARCH_WIDTH = 128
#: A shard's search is widened until it finds this share of the nearest of so many of its own
#: vectors, by brute force over the whole shard; so many nearest each.
RECALL = 0.96
MEASURED = 64
MEASURED_NEAREST = 20
#: Candidates among which links are chosen.
CHOICE = 48
#: Vectors inserted, or searched for, at once.
BLOCK = 256
EXPANDED = 4
#: Vectors of one shard, and queries of one block, on average at most. There are at least
#: MIN_SHARDS, so that the work spreads.
SHARD_ROWS = 50_000
MIN_SHARDS = 8
QUERY_ROWS = 20_000


def choose(points: np.ndarray, center: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
    """Of each row of positions ``found`` (-1: none, nearest first) up to ``n`` to link to.

    One is taken if it is nearer to the center than to any taken before; if too few are,
    the nearest of the others follow.
    """
    rows, width = found.shape
    there = points[np.maximum(found, 0)]
    near = np.where(found >= 0, np.einsum("bcd,bd->bc", there, center), -np.inf)
    among = there @ there.transpose(0, 2, 1)
    taken = np.zeros((rows, width), bool)
    closest = np.full((rows, width), -np.inf)  # largest product with any taken so far
    for k in range(width):
        good = (found[:, k] >= 0) & (near[:, k] > closest[:, k]) & (taken.sum(axis=1) < n)
        taken[:, k] = good
        closest[good] = np.maximum(closest[good], among[good, k])
    order = np.lexsort((-near, ~taken), axis=1)[:, :n]
    return np.take_along_axis(found, order, axis=1)


class Graph:
    """Levels of flat neighbour arrays over unit-norm-extended vectors."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray):
        norms = (vectors.astype(np.float64) ** 2).sum(axis=1)
        self.largest = float(norms.max(initial=0.0))
        rest = np.sqrt(np.maximum(self.largest - norms, 0))
        scale = 1 / math.sqrt(self.largest or 1.0)
        self.points = (np.hstack([vectors, rest[:, None]]) * scale).astype(np.float32)
        self.levels = levels
        self.row, self.links = [], []
        for level in range(int(levels.max(initial=0)) + 1):
            on = levels >= level
            self.row.append(np.where(on, np.cumsum(on) - 1, -1))
            self.links.append(np.full((int(on.sum()), LINKS * (1 if level else 2)), -1, np.int32))
        self.entry = -1

    def walk(self, level: int, queries: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
        """The best positions on ``level`` per query, nearest first, from ``start`` on."""
        b = len(queries)
        seen = np.zeros((b, len(self.points) + 1), bool)  # the last column takes the -1s
        rows = np.arange(b)[:, None]
        ids = np.full((b, width), -1)
        ids[:, : start.shape[1]] = start[:, :width]
        seen[rows, ids] = True
        near = np.einsum("bcd,bd->bc", self.points[np.maximum(ids, 0)], queries)
        near[ids < 0] = -np.inf
        fresh = ids >= 0
        alive = np.arange(b)
        while len(alive):
            a = np.arange(len(alive))[:, None]
            score = np.where(fresh[alive], near[alive], -np.inf)
            best = np.argpartition(-score, min(EXPANDED, width) - 1, axis=1)[:, :EXPANDED]
            usable = np.take_along_axis(score, best, axis=1) > -np.inf
            going = usable.any(axis=1)
            alive, best, usable = alive[going], best[going], usable[going]
            if not len(alive):
                break
            a = alive[:, None]
            from_ = np.where(usable, ids[a, best], -1)
            fresh[a, best] = False
            next_ = self.links[level][self.row[level][np.maximum(from_, 0)]]
            next_ = np.where((from_ >= 0)[:, :, None], next_, -1).reshape(len(alive), -1)
            next_ = np.sort(next_, axis=1)
            next_[:, 1:][next_[:, 1:] == next_[:, :-1]] = -1
            next_ = np.where(seen[a, next_], -1, next_)
            seen[a, next_] = True
            close = np.einsum("bcd,bd->bc", self.points[np.maximum(next_, 0)], queries[alive])
            close[next_ < 0] = -np.inf
            all_ids = np.hstack([ids[alive], next_])
            all_near = np.hstack([near[alive], close])
            all_fresh = np.hstack([fresh[alive], next_ >= 0])
            keep = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
            ids[alive] = np.take_along_axis(all_ids, keep, axis=1)
            near[alive] = np.take_along_axis(all_near, keep, axis=1)
            fresh[alive] = np.take_along_axis(all_fresh, keep, axis=1) & (near[alive] > -np.inf)
        order = np.argsort(-near, axis=1, kind="stable")
        return np.where(np.take_along_axis(near, order, axis=1) > -np.inf, np.take_along_axis(ids, order, axis=1), -1)

    def descend(self, queries: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
        """Level and best positions, from the entry's level down to 0."""
        start = np.full((len(queries), 1), self.entry)
        for level in range(int(self.levels[self.entry]), -1, -1):
            found = self.walk(level, queries, start, width if level == 0 else max(LINKS, width // 4))
            yield level, found
            start = found[:, :EXPANDED]

    def insert(self, new: np.ndarray) -> None:
        """Link a block of positions to those before and to each other."""
        q = self.points[new]
        before = dict(self.descend(q, BUILD_WIDTH)) if self.entry >= 0 else {}
        among = q @ q.T
        np.fill_diagonal(among, -np.inf)
        for level in range(int(self.levels[new].max()) + 1):
            on = np.flatnonzero(self.levels[new] >= level)
            own = among[np.ix_(on, on)]
            mates = np.argsort(-own, axis=1)[:, : max(min(LINKS, len(on) - 1), 0)]
            found = np.where(np.take_along_axis(own, mates, axis=1) > -np.inf, new[on][mates], -1)
            if level in before:
                found = np.hstack([before[level][on], found])
            if not found.shape[1]:
                continue
            self.connect(level, new[on], self.nearest(q[on], found, CHOICE))
        top = new[np.argmax(self.levels[new])]
        if self.entry < 0 or self.levels[top] > self.levels[self.entry]:
            self.entry = int(top)

    def nearest(self, center: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
        near = np.einsum("bcd,bd->bc", self.points[np.maximum(found, 0)], center)
        near[found < 0] = -np.inf
        order = np.argsort(-near, axis=1, kind="stable")[:, :n]
        return np.take_along_axis(found, order, axis=1)

    def connect(self, level: int, new: np.ndarray, found: np.ndarray) -> None:
        links, row = self.links[level], self.row[level]
        chosen = choose(self.points, self.points[new], found, LINKS)
        links[row[new], : chosen.shape[1]] = chosen
        # And back: each vector that was chosen weighs its links and the new ones together.
        to, from_ = chosen.ravel(), np.repeat(new, chosen.shape[1])
        to, from_ = to[to >= 0], from_[to >= 0]
        order = np.argsort(to, kind="stable")
        to, from_ = to[order], from_[order]
        nodes, first, count = np.unique(to, return_index=True, return_counts=True)
        if not len(nodes):
            return
        added = np.full((len(nodes), int(count.max())), -1)
        added[np.repeat(np.arange(len(nodes)), count), np.arange(len(to)) - np.repeat(first, count)] = from_
        both = np.hstack([links[row[nodes]], added])
        for at in range(0, len(nodes), BLOCK):
            part = slice(at, at + BLOCK)
            center = self.points[nodes[part]]
            ranked = self.nearest(center, both[part], both.shape[1])
            width = int((ranked >= 0).sum(axis=1).max())
            kept = ranked[:, :width]
            if width > links.shape[1]:
                kept = choose(self.points, center, kept, links.shape[1])
            out = np.full((len(kept), links.shape[1]), -1, np.int32)
            out[:, : kept.shape[1]] = kept
            links[row[nodes[part]]] = out

    def build(self) -> None:
        n, at = len(self.points), 0
        while at < n:
            size = min(BLOCK, max(at, 32), n - at)
            self.insert(np.arange(at, at + size))
            at += size

    def search(self, queries: np.ndarray, n: int, width: int) -> np.ndarray:
        """Up to ``n`` positions per query, nearest first; -1 where there are fewer."""
        q = np.hstack([queries, np.zeros((len(queries), 1), np.float32)]).astype(np.float32)
        for _, found in self.descend(q, max(width, n)):
            pass
        return found[:, :n]

    def nearest_of_all(self, q: np.ndarray, n: int) -> np.ndarray:
        """By brute force, to measure a search by."""
        near = q @ self.points.T
        n = min(n, near.shape[1])
        found = np.argpartition(-near, n - 1, axis=1)[:, :n]
        order = np.argsort(-np.take_along_axis(near, found, axis=1), axis=1, kind="stable")
        return np.take_along_axis(found, order, axis=1)

    def width_for(self, queries: np.ndarray, recall: float = RECALL) -> int:
        """The least width, doubling, at which a search of ``queries`` has the given recall."""
        q = np.hstack([queries, np.zeros((len(queries), 1), np.float32)]).astype(np.float32)
        n = min(MEASURED_NEAREST, len(self.points))
        exact = np.sort(self.nearest_of_all(q, n), axis=1)
        width = SEARCH_WIDTH
        while width < len(self.points):
            found = self.search(queries, n, width)
            hit = sum(np.isin(f, e).sum() for f, e in zip(found, exact, strict=True))
            if hit >= recall * exact.size:
                break
            width *= 2
        return width


INDEX = "dim int, shard int, n int, ids array<long>, vectors binary, levels binary, entry int, width int, links array<binary>"


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim)


def build_index(nodes: DataFrame, shards: int, seed: int = 7) -> DataFrame:
    """Graphs of ``dim, node, vector``, one row per dimension and shard; see ``INDEX``."""

    def of(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        dim, shard = rows["dim"][0].as_py(), rows["shard"][0].as_py()
        vectors = _matrix(rows["vector"], dim)
        rng = np.random.default_rng([seed, shard])
        order = rng.permutation(len(vectors))
        vectors = vectors[order]
        levels = np.floor(-np.log(1 - rng.random(len(vectors))) / math.log(LINKS)).astype(np.uint8)
        graph = Graph(vectors, levels)
        graph.build()
        asked = rng.choice(len(vectors), min(MEASURED, len(vectors)), replace=False)
        row = {
            "dim": dim,
            "shard": shard,
            "n": len(vectors),
            "ids": rows["node"].to_numpy()[order].tolist(),
            "vectors": vectors.tobytes(),
            "levels": levels.tobytes(),
            "entry": graph.entry,
            "width": graph.width_for(vectors[asked]),
            "links": [x.tobytes() for x in graph.links],
        }
        return pa.Table.from_pylist([row], _INDEX_ARROW)

    shard = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard")
    return nodes.select("dim", shard, "node", "vector").groupBy("dim", "shard").applyInArrow(of, INDEX)


_INDEX_ARROW = pa.schema(
    [
        ("dim", pa.int32()),
        ("shard", pa.int32()),
        ("n", pa.int32()),
        ("ids", pa.list_(pa.int64())),
        ("vectors", pa.binary()),
        ("levels", pa.binary()),
        ("entry", pa.int32()),
        ("width", pa.int32()),
        ("links", pa.list_(pa.binary())),
    ]
)
_FOUND = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("score", pa.float64())])


def load_graph(row: dict) -> tuple[Graph, np.ndarray, np.ndarray]:
    """The graph, the ids and the vectors of an index row."""
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(row["n"], row["dim"])
    graph = Graph(vectors, np.frombuffer(row["levels"], np.uint8))
    graph.links = [
        np.frombuffer(x, np.int32).reshape(-1, LINKS * (1 if level else 2)) for level, x in enumerate(row["links"])
    ]
    graph.entry = row["entry"]
    return graph, np.asarray(row["ids"], np.int64), vectors


def search_index(index: DataFrame, queries: DataFrame, n: int, width: int | None = None) -> DataFrame:
    """``query, node, score`` of the ``n`` best of each shard for ``dim, query, vector``.

    By default a shard is searched at the width that was measured when it was built. Queries go to every shard of their dimension, in blocks; a task holds one shard's graph
    and one block.
    """
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    spread = index.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), *index.columns)
    targets = index.select(F.col("dim").alias("dim"), F.col("shard").alias("shard"))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")).join(targets, "dim")

    def of(graphs: pa.Table, block: pa.Table) -> pa.Table:
        if not graphs.num_rows or not block.num_rows:
            return _FOUND.empty_table()
        row = graphs.to_pylist()[0]
        graph, ids, vectors = load_graph(row)
        q, names = _matrix(block["vector"], vectors.shape[1]), block["query"].to_numpy()
        out = []
        for at in range(0, len(q), BLOCK):
            part = q[at : at + BLOCK]
            found = graph.search(part, min(n, len(ids)), width or row["width"])
            rows, _ = np.nonzero(found >= 0)
            at_ = found[found >= 0]
            score = (part[rows] * vectors[at_]).sum(axis=1)
            out.append(pa.Table.from_arrays([pa.array(names[at + rows]), pa.array(ids[at_]), pa.array(score)], schema=_FOUND))
        return pa.concat_tables(out)

    keys = ("dim", "shard", "block")
    return (
        spread.groupBy(*keys)
        .cogroup(asked.select(*keys, "query", "vector").groupBy(*keys))
        .applyInArrow(of, "query long, node long, score double")
    )


def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components that aren't zero or empty."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of each query.

    Queries and candidates are the rows of ``vectors``; a query isn't its own candidate.
    Rows without an id and unusable vectors take no part; vectors of another dimension than
    the query's aren't candidates. Rows that repeat id and vector count once. Ties go to the
    smaller id. With fewer than ``k`` candidates there are fewer rows, and none from an
    empty table. Other columns are not read.
    """
    rows = vectors.filter(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("asks")
    )
    same = Window.partitionBy("vector").orderBy("id")
    # The limit on ranks is applied within each task before vectors are exchanged.
    members = rows.select("vector", "id").distinct().withColumn("r", F.row_number().over(same)).filter(F.col("r") <= k + 1)
    classes = members.groupBy("vector").agg(F.min("id").alias("node"), F.array_sort(F.collect_list("id")).alias("ids"))
    classes = stored(classes.select(F.size("vector").alias("dim"), "node", "vector", "ids"), "vectors")
    shards = max(MIN_SHARDS, -(-classes.count() // SHARD_ROWS))
    index = stored(build_index(classes, shards), "graphs")
    queries = rows.filter("asks").select(F.size("vector").alias("dim"), F.col("id").alias("query"), "vector").distinct()
    found = search_index(index, queries, k + 1)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    found = found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1)
    found = found.join(classes.select("node", "ids"), "node")
    found = found.select("query", "score", F.explode("ids").alias("id")).filter("id != query")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
