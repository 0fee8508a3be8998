"""Neighbours against brute force."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, is_query, k):
    """Best k of every query: (score, id), by the double-precision inner product."""
    ok = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)})
    out = {}
    for i, v in ok:
        if is_query(i):
            near = [(-float(np.dot(np.float64(v), np.float64(w))), j) for j, w in ok if j != i and len(w) == len(v)]
            out[i] = [j for _, j in sorted(near)[:k]]
    return out


def test_recall_and_ranks(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(6, 16))
    vectors = (centers[rng.integers(0, 6, 1_500)] + 0.7 * rng.normal(size=(1_500, 16))).astype(np.float32)
    vectors *= rng.uniform(0.5, 2.0, (1_500, 1)).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    found = hnsw.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, 20).collect()
    want = brute_force([r[:2] for r in rows], lambda i: i % 20 == 0, 20)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == set(want)
    hits = sum(len({r.vec_id for r in got[q]} & set(want[q])) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    for q, best in got.items():
        assert [r["rank"] for r in best] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in best] == sorted((-r.score, r.vec_id) for r in best)
        for r in best:
            assert abs(r.score - np.dot(vectors[q].astype(float), vectors[r.vec_id].astype(float))) < 1e-9


def test_copies_ties_and_odd_rows(spark):
    one, other = [1.0, 0.0, 2.0], [0.5, 1.0, 0.0]
    rows = [(i, one, 0) for i in range(0, 90)] + [(200 + i, other, 0) for i in range(3)]
    rows += [(0, one, 0), (300, None, 0), (301, [], 0), (302, [0.0, 0.0, 0.0], 0), (303, [1.0, None, 1.0], 0)]
    rows += [(304, [float("nan"), 1.0, 1.0], 0), (305, [float("inf"), 1.0, 1.0], 0), (None, one, 0), (306, [1.0, 2.0], 0), (308, [2.0, 1.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("mine"))
    found = hnsw.nearest(df, F.col("vec_id") % 2 == 0, 20).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == brute_force([r[:2] for r in rows], lambda i: i % 2 == 0, 20)
    assert hnsw.nearest(df.limit(0), F.lit(True), 20).count() == 0


def test_blocks_of_queries_and_stored_graphs(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "QUERY_ROWS", 7)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), 0) for i in range(120)]
    found = hnsw.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 4 == 0, 5).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == brute_force([r[:2] for r in rows], lambda i: i % 4 == 0, 5)


def test_links_are_flat_and_mutual_enough():
    vectors = np.random.default_rng(2).normal(size=(600, 12))
    levels = (np.arange(600) % 16 == 0).astype(np.uint8)
    graph = hnsw.Graph(vectors, levels)
    graph.build()
    assert [x.shape for x in graph.links] == [(600, 32), (38, 16)]
    assert all((x < 600).all() and x.dtype == np.int32 for x in graph.links)
    assert (graph.links[0][:, 0] >= 0).all()


def test_search_is_widened_until_it_finds_enough():
    """Of vectors with differing norms a walk of the usual width misses many."""
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((2_500, 48)) * rng.uniform(0.5, 2, (2_500, 1))
    levels = np.floor(-np.log(1 - rng.random(len(vectors))) / np.log(hnsw.LINKS)).astype(np.uint8)
    graph = hnsw.Graph(vectors, levels)
    graph.build()
    width = graph.width_for(vectors[rng.choice(len(vectors), 64, replace=False)])
    q = vectors[rng.choice(len(vectors), 100, replace=False)]
    exact = np.argsort(-(q @ vectors.T), axis=1)[:, :20]
    share = lambda w: sum(np.isin(f, e).sum() for f, e in zip(graph.search(q, 20, w), exact)) / exact.size
    assert width > hnsw.SEARCH_WIDTH and share(hnsw.SEARCH_WIDTH) < 0.9 <= share(width)
