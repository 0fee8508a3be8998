"""Near-duplicates against all pairs, and components against a union-find."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import near_duplicates as nd
from tidemark.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    size = min(5, len(words))
    return frozenset(tuple(words[p : p + size]) for p in range(len(words) - size + 1))


def closure(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def brute_force(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in closure(ids, links).items()}


def corpus(seed, groups=12, copies=9):
    """Groups of copies with ever more edits, exact copies, and texts with one passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, rows = text(40), []
    for g in range(groups):
        base = text(rng.randrange(20, 160))
        for c in range(copies):
            own = list(base)
            for _ in range(rng.randrange(0, 2 + len(own) // 30)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append(" ".join(own) if c % 3 else " ".join(own).upper())
    for _ in range(30):
        rows.append(" ".join(passage + text(rng.randrange(5, 20))))
    rows += ["", " \t", "one two", "One  TWO", "one two three"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_duplicates(df).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(docs, seed):
    rows = corpus(seed)
    assert result(docs(*rows)) == brute_force(rows)


def test_what_hubs_leave_open_is_found_exactly(docs, monkeypatch):
    """With every member compared with one that it isn't similar to, all links come late."""
    rows = corpus(3)
    monkeypatch.setattr(nd, "BANDS", 24)
    monkeypatch.setattr(nd, "ROWS", 1)
    monkeypatch.setattr(nd.sketches, "__defaults__", (24, 1))
    monkeypatch.setattr(nd, "SIGNATURE_SHARE", 0.0)
    assert result(docs(*rows)) == brute_force(rows)


def test_odd_rows(docs):
    text = " ".join(f"t{k}" for k in range(30))
    df = docs((5, text), (5, text), (9, text + " more"), (None, text), (7, None), (8, ""), (3, "a b"), (2, "A\tb"))
    out = nd.near_duplicates(df.withColumn("print", F.lit("mine"))).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in out) == [
        (0, 26, 0, True),
        (2, 1, 2, True),
        (3, 1, 2, False),
        (5, 26, 5, True),
        (5, 26, 5, True),
        (7, 0, 7, True),
        (8, 0, 8, True),
        (9, 27, 5, False),
    ]
    assert nd.near_duplicates(df.limit(0)).count() == 0
    kept = nd.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [2, 5, 7, 8]


def words(*ids):
    return " ".join(f"t{k}" for k in ids)


def test_repeated_ids_are_linked_whatever_their_texts(docs):
    one, other = words(*range(30)), words(*range(50, 80))
    rows = [(5, one), (5, other), (6, one + " more"), (7, other + " more"), (3, words(*range(90, 99)))]
    out = nd.near_duplicates(docs(*rows)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in out) == [
        (3, 3, True),
        (5, 5, True),
        (5, 5, True),
        (6, 5, False),
        (7, 5, False),
    ]
    assert sorted(r.doc_id for r in nd.keep_one(docs(*rows)).collect()) == [3, 5]


def test_one_row_of_each_component_stays(docs):
    one, other, third = words(*range(30)), words(*range(50, 80)), words(*range(100, 130))
    rows = [(1, one), (1, one), (2, other), (None, one), (None, one), (3, one)]
    rows += [(None, third), (None, third + " x"), (None, None), (None, " "), (9, ""), (9, "")]
    df = docs(*rows).withColumn("mark", F.lit("mine"))
    kept = nd.keep_one(df)
    assert kept.columns == df.columns
    found = [(r.doc_id, (r.text or "").strip()) for r in kept.collect()]
    assert sorted(i for i, _ in found if i) == [1, 2, 9]
    assert sorted(t for i, t in found if not i) in (["", "", third], ["", "", third + " x"])


@pytest.mark.parametrize("rows_at_once", [1_000_000, 0])
def test_texts_of_one_template_are_not_paired(docs, monkeypatch, rows_at_once):
    """Pairs that are checked in the end grow with the documents, not with their square."""
    monkeypatch.setattr(nd, "BROADCAST_IDS", rows_at_once)
    counted = {}
    pairs = nd.exact_pairs
    for n in (60, 120):
        monkeypatch.setattr(nd, "exact_pairs", lambda *a, n=n: (df := pairs(*a), counted.update({n: df.count()}))[0])
        template = words(*range(80))
        rows = [(k, f"{template} " + words(*range(1_000 * k + 1_000, 1_000 * k + 1_020))) for k in range(n)]
        assert result(docs(*rows)) == {k: (96, k) for k in range(n)}
    assert counted == {60: 0, 120: 0}


def test_one_large_group_of_copies(docs):
    text = " ".join(f"t{k}" for k in range(30))
    rows = [(k, text) for k in range(300)] + [(1000 + k, f"{text} x{k}") for k in range(60)]
    out = result(docs(*rows))
    assert {c for _, c in out.values()} == {0}


def test_minima_estimate_similarity():
    rng = np.random.default_rng(0)
    both = rng.integers(0, 1 << 63, 6_000, np.uint64)
    one, other = np.unique(both[:4_500]), np.unique(both[1_500:])
    minima = nd.Minima(2_000)
    share = (minima(one) == minima(other)).mean()
    assert share == pytest.approx(0.5, abs=0.05)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_star_steps_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)]
    edges += [(100 + k, 101 + k) for k in range(20)] + [(300, 300 + k) for k in range(1, 30)]
    edges += edges[:5] + [(7, 7)]
    df = spark.createDataFrame([*edges, (None, 3)], "u long, v long")
    got = {r.node: r.component for r in components(df).collect()}
    linked = {n for e in edges if e[0] != e[1] for n in e}
    assert got == closure(linked, [e for e in edges if e[0] != e[1]])
    assert components(df.limit(0)).count() == 0


def test_few_ids_are_sent_to_the_texts(spark, docs):
    text = " ".join(map(str, range(30)))
    df = docs((1, text), (2, text), (3, "another text"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = nd.keep_one(df)
        assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
