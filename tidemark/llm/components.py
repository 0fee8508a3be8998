"""Connected components by alternating large-star and small-star steps.

Edges are kept as (node, smaller node). A large-star step connects every larger neighbour
of a node to the smallest of its neighbourhood, a small-star step the smaller ones; both
keep the components, and in the end every node points at the smallest of its component.
Neighbourhoods are reduced to their minimum before anything is joined, and no step gathers
a neighbourhood in one place. Each round is written out, so lineage doesn't grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _nearest(edges: DataFrame) -> DataFrame:
    """``u, m``: the smallest of each node and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    larger = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return larger.join(_nearest(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    nearest = _nearest(edges)
    moved = edges.join(nearest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = nearest.select("u", F.col("m").alias("v"))
    return moved.filter("u != v").unionAll(own).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node that each node of ``edges(u, v)`` reaches.

    Edges may come in either direction and more than once; loops and nulls are left out.
    Nodes without an edge don't appear, so a table without edges gives no rows.
    """
    current = stored(
        edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    mark = _mark(current)
    while mark[0]:
        current = stored(_small_star(_large_star(current)), "edges")
        before, mark = mark, _mark(current)
        if mark == before:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
