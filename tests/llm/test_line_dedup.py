"""Dropped lines against a plain count of lines."""

from __future__ import annotations

import random
import string

import pytest
from pyspark.sql import functions as F

from tidemark.llm import line_dedup

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute_force(texts, min_docs, min_chars=1):
    split = [(t or "").split("\n") for t in texts]
    key = lambda line: line.strip(" \t\n\v\f\r").translate(LOWER)
    count = {}
    for lines in split:
        for k in {key(x) for x in lines}:
            count[k] = count.get(k, 0) + 1
    gone = {k for k, n in count.items() if n >= min_docs and len(k) >= min_chars}
    return [(len(x), sum(key(y) in gone for y in x), "\n".join(y for y in x if key(y) not in gone)) for x in split]


def corpus(seed, n=60):
    rng = random.Random(seed)
    lines = [f"line {k}" for k in range(12)] + ["", " ", "\tLine 3 ", "É", "é", "LINE 4\r", " line 5", "ſ", "K"]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(9))) for _ in range(n)]
    return [*texts, None, "", "\n", "\n\n", *["line 1\nline 1\nown"] * 12, "x" * 300_000, "line 2\n" * 5_000]


def result(df, **more):
    return sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.drop_frequent_lines(df, **more).collect())


@pytest.mark.parametrize("broadcast,hot", [(500_000, 100_000), (0, 20), (0, 1)])
def test_equals_a_plain_count(docs, monkeypatch, broadcast, hot):
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", broadcast)
    monkeypatch.setattr(line_dedup, "HOT", hot)
    for min_docs, min_chars in ((10, 1), (2, 0), (14, 4)):
        texts = corpus(min_docs)
        want = [(i, *w) for i, w in enumerate(brute_force(texts, min_docs, min_chars))]
        assert result(docs(*enumerate(texts)), min_docs=min_docs, min_chars=min_chars) == want


def test_odd_rows(docs):
    rows = [(1, "a\nb"), (1, "a\nb"), (1, "a\nc"), (None, "a"), (None, None), (2, "")]
    df = docs(*rows).withColumns({"key": F.lit(1), "pos": F.lit("p"), "hot": F.lit(0)})
    out = line_dedup.drop_frequent_lines(df, min_docs=4).collect()
    assert sorted((r.doc_id or 0, r.n_lines, r.n_dropped, r.kept_text) for r in out) == [
        (0, 1, 0, ""),
        (0, 1, 1, ""),
        (1, 2, 1, "b"),
        (1, 2, 1, "b"),
        (1, 2, 1, "c"),
        (2, 1, 0, ""),
    ]
    assert line_dedup.drop_frequent_lines(df.limit(0)).count() == 0


def test_main_path_has_no_python(docs):
    plan = line_dedup.drop_frequent_lines(docs((1, "a")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExternalRDD" not in plan.split("Physical")[0].replace("LogicalRDD", "")
