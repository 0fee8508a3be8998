"""The trie against one built turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversation_trie as trie

TURNS = "conv_id long, turn long, role string, text string"


def original(rows):
    held = {}
    for c, turn, role, text in rows:
        if c is not None:
            held.setdefault(c, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in held.items()}


def brute_force(sequences):
    members, paths = {}, {c: [tuple(s[:d]) for d in range(len(s) + 1)] for c, s in sequences.items()}
    for c, path in paths.items():
        for node in path:
            members.setdefault(node, []).append(c)
    children = Counter(n[:-1] for n in members if n)
    saved, leaves = Counter(), Counter()
    for node, held in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(held) - 1) * (len(node[-1][1]) if node else 0)
            leaves[node[:d]] += node not in children
    out = []
    for node, held in members.items():
        ends = ",".join(map(str, sorted(c for c in held if len(sequences[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(held), len(node), parent, len(held), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed, n=60):
    """Conversations that share beginnings of any length, some of them whole."""
    rng = random.Random(seed)
    turn = lambda: (rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "é", "", None, "ccc"]))
    stems = [[turn() for _ in range(rng.randrange(14))] for _ in range(6)]
    rows = []
    for c in range(n):
        stem = rng.choice(stems)
        held = stem[: rng.choice([len(stem), rng.randrange(len(stem) + 1)])] + [turn() for _ in range(rng.choice([0, 0, 1, 6]))]
        rows += [(c * 3, k if rng.random() < 0.9 else k // 2, *t) for k, t in enumerate(held)]
    rows += rows[:4] + [(7, None, "user", "x"), (7, None, None, None), (None, 1, "user", "lost")]
    rng.shuffle(rows)
    return rows


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed,block,piece,hot,target", [(1, 4, 1_000, 10_000, None), (2, 1, 2, 3, 3), (3, 3, 1, 1, 2)])
def test_equals_a_trie_built_turn_by_turn(spark, monkeypatch, seed, block, piece, hot, target):
    for name, value in (("BLOCK", block), ("PIECE", piece), ("HOT", hot)):
        monkeypatch.setattr(trie, name, value)
    rows = made(seed)
    turns = trie.numbered(spark.createDataFrame(rows, TURNS).withColumn("at", F.lit("mine")))
    ids = [*{r[0] for r in rows if r[0] is not None}, 1_000, 1_001]
    convs = spark.createDataFrame([(i,) for i in [*ids, *ids[:3]]], "conv_id long")
    want = original(rows) | {1_000: [], 1_001: []}
    assert result(trie.prefix_trie(turns, convs, target)) == brute_force(want)


def test_rebuilt_conversations(spark):
    rows = [(c, k, "u", f"{c}.{k}") for c in range(3, 40) for k in range(c % 11 + 1)]
    first, convs = trie.rebuilt(trie.numbered(spark.createDataFrame(rows, TURNS)))
    plain = original(rows)
    want = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 9
        want[c] = plain.get(c - c % 5, [])[:h] + own[h:]
    assert any(not s for s in want.values())
    assert result(trie.prefix_trie(first, convs)) == brute_force(want)


def test_one_long_conversation_and_many_equal_ones(spark):
    rows = [(1, k, "u", f"t{k % 7}") for k in range(400)] + [(c, k, "u", f"t{k}") for c in range(2, 150) for k in range(3)]
    turns = trie.numbered(spark.createDataFrame(rows, TURNS))
    convs = spark.createDataFrame([(c,) for c in range(1, 150)], "conv_id long")
    assert result(trie.prefix_trie(turns, convs, 20)) == brute_force(original(rows))


def test_without_rows(spark):
    turns, convs = spark.createDataFrame([], TURNS), spark.createDataFrame([], "conv_id long")
    assert trie.prefix_trie(trie.numbered(turns), convs).count() == 0
    alone = trie.prefix_trie(trie.numbered(turns), spark.createDataFrame([(4,)], "conv_id long")).collect()
    assert [tuple(r) for r in alone] == [(4, 0, None, 1, 0, 1, 0, hashlib.sha256(b"4").hexdigest())]
