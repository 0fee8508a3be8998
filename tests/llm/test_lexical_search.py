"""Ranked search against scores of all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute_force(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        found = []
        for i, c in held:
            m = 25 + (75 * sum(c.values()) * n_docs) // max(total, 1)
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, i))
        out += [(item_id, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def corpus(seed, n=400):
    """Words of very different frequency, lengths from none to hundreds, and copies."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(200)] + ["Äpfel", "ONE", "two3", "日本"]
    text = lambda size: " ".join(words[min(int(rng.paretovariate(0.6)) - 1, len(words) - 1)] for _ in range(size))
    docs = [text(rng.choice([1, 3, 20, 60, 300])) for _ in range(n)]
    docs += [docs[0], docs[1], docs[1], None, "", "--", "wide " * 3_000]
    items = [text(rng.choice([1, 4, 12, 40])) for _ in range(30)] + ["", None, "unheard", "w0 w0 w0 w1", docs[1], "two3--ONE"]
    ids = rng.sample(range(10_000), len(docs))
    return list(zip(ids, docs)), list(enumerate(items))


def result(df):
    return sorted(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize(
    "seed,shard,postings,ordinals,items,broadcast,k", [(1, 16 << 20, 128, 2_048, 500, 100_000, 10), (2, 9_000, 4, 16, 7, 0, 3), (3, 40_000, 3, 5, 100, 0, 10)]
)
def test_equals_scores_of_all_documents(spark, docs, monkeypatch, seed, shard, postings, ordinals, items, broadcast, k):
    for name, value in zip(("SHARD_BYTES", "POSTINGS", "ORDINALS", "ITEMS", "BROADCAST_TERMS"), (shard, postings, ordinals, items, broadcast)):
        monkeypatch.setattr(ls, name, value)
    rows, asked = corpus(seed)
    index = ls.build_index(docs(*rows).withColumn("term", F.lit("mine")))
    benchmark = spark.createDataFrame([*asked, asked[0]], "item_id long, text string")
    assert result(ls.search(index, benchmark, k)) == brute_force(rows, asked, k)


def postings(weight, ordinals, worth):
    lists = ls.packed(ordinals, worth, np.array([len(ordinals)]))
    return ls.Postings(weight, len(ordinals), *(ls.as_binary(*c)[0].as_py() for c in lists.columns))


def test_blocks_without_a_chance_are_not_unpacked(monkeypatch):
    monkeypatch.setattr(ls, "POSTINGS", 16)
    monkeypatch.setattr(ls, "ORDINALS", 64)
    rng = np.random.default_rng(0)
    n = 4_096
    rare, common = np.sort(rng.choice(n, 60, replace=False)), np.arange(n)
    lists = []
    for weight, held in ((1_000, rare), (3, common)):
        lists.append((1, postings(weight, held, rng.integers(1, 1_000, len(held)))))
    total = np.zeros(n, np.int64)
    for _, p in lists:
        for ordinals, values in p.within(0, n):
            total[ordinals] += p.weight * values
    for _, p in lists:
        p.open.clear()
    found, scores = ls.best(lists, n, 10)
    want = np.lexsort((np.arange(n), -total))[:10]
    assert found.tolist() == want.tolist() and scores.tolist() == total[want].tolist()
    assert len(lists[1][1].open) < 60 < len(lists[1][1].lasts)


def test_packing_round_trip():
    for top in (1, 200, 70_000, 5_000_000_000):
        ordinals = np.unique(np.random.default_rng(top).integers(0, top, 300))
        values = np.arange(len(ordinals)) * (top // 7) + 1
        p = postings(1, ordinals, values)
        got = [np.concatenate(c) for c in zip(*p.within(0, top))]
        assert got[0].tolist() == ordinals.tolist() and got[1].tolist() == values.tolist()


def test_odd_rows(spark, docs):
    index = ls.build_index(docs((5, "a b"), (5, "a b"), (None, "a"), (None, "a"), (3, None), (4, "")))
    assert (index.n_docs, index.n_terms) == (4, 6)
    items = spark.createDataFrame([(1, "B"), (None, "b"), (2, "c"), (1, "b a")], "item_id long, text string")
    out = ls.search(index, items).collect()
    assert sorted((r.item_id or 0, r["rank"], r.doc_id or 0) for r in out) == [
        *((0, 1, 5), (0, 2, 5), (1, 1, 5), (1, 1, 5), (1, 2, 5), (1, 2, 5)),
        *((1, 3, 0), (1, 4, 0)),
    ]
    assert ls.search(index, items.limit(0)).count() == 0
    empty = ls.build_index(docs((1, "a")).limit(0))
    assert ls.search(empty, items).count() == 0
