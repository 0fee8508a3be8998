"""Sharding, quality, language and decontamination on small fixtures."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language_id, quality_ranking, sharding
from tidemark.llm.common import held_out

def teach():
    return ~held_out(F.col("doc_id"))


def test_shards_are_even_gapless_and_mixed(docs, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 10)
    rows = [(i, f"text {i}", None, "hot" if i % 3 == 0 else f"s{i % 4}") for i in range(203)]
    out = sharding.interleaved_shards(docs(*rows), 8).collect()
    assert len(out) == 203 and {r.doc_id for r in out} == set(range(203))
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert {len(s) for s in slots.values()} == {25, 26}
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total = Counter(r.source for r in out)
    for shard in range(8):
        own = Counter(r.source for r in out if r.shard == shard)
        assert all(abs(own[s] - n / 8) <= 2 for s, n in total.items())
    again = sharding.interleaved_shards(docs(*reversed(rows)), 8).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in out}


def test_shards_of_odd_rows(docs):
    df = docs((1, None), (1, None), (None, "é"), (2, "", None, "a")).withColumn("slot", F.lit("mine"))
    out = sharding.interleaved_shards(df, 16).collect()
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in out) == [
        (0, 3, zlib.crc32("é".encode())),
        (1, 1, 0),
        (1, 1, 0),
        (2, 1, 0),
    ]
    assert sorted((r.shard, r.slot) for r in out) == [(k, 0) for k in range(4)]
    assert sharding.interleaved_shards(df.limit(0), 16).count() == 0


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."


def labelled(n=240):
    rng = random.Random(5)
    words = ["tree", "river", "stone", "green", "walks", "under", "light", "the", "a", "of"]
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        text = prose(rng, words, rng.randrange(5, 60))
        rows.append((i, text if good else text.upper().replace(" ", "!! ")))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality_ranks_held_out_documents(spark, docs):
    rows, labels = labelled()
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = quality_ranking.rank_quality(docs(*rows), known, teach()).collect()
    want = {i: q for i, q, _ in labels}
    assert all(r.predicted == want[r.doc_id] for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert {r.learn for r in out} == {True, False}


def test_quality_learns_from_no_held_out_label(spark, docs):
    rows, labels = labelled()
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    score = [
        {r.doc_id: r.score for r in quality_ranking.rank_quality(docs(*rows), spark.createDataFrame(k, "doc_id long, quality int, toxic int"), teach()).collect()}
        for k in (labels, flipped)
    ]
    assert score[0] == score[1]


def test_quality_of_odd_rows_and_missing_labels(spark, docs):
    df = docs((1, None), (2, ""), (None, "some text"), (1, None), (3, "x" * 200_000))
    df = df.withColumn("score", F.lit("mine"))
    for labels, predicted in (([], 1), ([(1, 1, 0)], 1), ([(2, 0, 0), (1, 0, 0), (4, None, 0)], 0)):
        known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        out = quality_ranking.rank_quality(df, known, F.lit(True)).collect()
        assert len(out) == 5 and {r.predicted for r in out} == {predicted}
    assert quality_ranking.rank_quality(df.limit(0), known, teach()).count() == 0


VOCABULARY = {
    "en": "the and with that from this have were they which",
    "de": "der und nicht eine auch sich wird durch über schön",
    "fr": "les des dans pour avec elle être nous très même",
    "es": "los que para con una está niño más también año",
    "tlh": "qapla wo batlh tlhingan hol qaq jatlh",
}


def spoken(n=150):
    rng = random.Random(8)
    langs = list(VOCABULARY)
    return [(i, prose(rng, VOCABULARY[langs[i % 5]].split(), 30), langs[i % 5], "s") for i in range(n)]


def test_languages_of_held_out_documents(docs):
    rows = spoken()
    out = language_id.identify(docs(*rows), teach()).collect()
    want = {i: lang for i, _, lang, _ in rows}
    assert all(r.lang_pred == want[r.doc_id] and 0 <= r.score <= 1 for r in out)


def test_language_of_odd_rows(docs):
    rows = [*spoken(), (900, None, "en"), (901, "12 .. 34", "en"), (902, "", None), (None, "the and with", None)]
    out = {r.doc_id: r for r in language_id.identify(docs(*rows), teach()).collect() if (r.doc_id or 900) >= 900}
    assert [out[i].lang_pred for i in (900, 901, 902, None)] == ["und", "und", "und", "en"]
    nothing = language_id.identify(docs((1, "some words", None)), teach()).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]
    alone = language_id.identify(docs((1, "some words", "en"), (2, "more", "en")), F.lit(True)).collect()
    assert {r.lang_pred for r in alone} == {"en"}
    assert language_id.identify(docs((1, "a", "en")).limit(0), teach()).count() == 0
    kept = language_id.keep_identified(docs(*rows), teach())
    assert kept.count() == 151 and kept.columns == docs(*rows).columns


WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall((text or "").encode().lower())


def brute_force(text, items, window=10):
    words = split(text)
    hit, found = set(), set()
    for item_id, item in items:
        w = split(item)
        size = min(window, len(w))
        windows = {tuple(w[p : p + size]) for p in range(len(w) - size + 1)} if w else set()
        for p in range(len(words) - size + 1):
            if tuple(words[p : p + size]) in windows:
                hit |= set(range(p, p + size))
                found.add(item_id)
    return len(words), len(hit), found


@pytest.mark.parametrize("slice_bytes", [200, 8 << 20])
def test_contamination_equals_brute_force(spark, docs, monkeypatch, slice_bytes):
    monkeypatch.setattr(decontamination, "SLICE_BYTES", slice_bytes)
    rng = random.Random(2)
    words = [f"w{k}" for k in range(7)] + ["Ünd", "B"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([0, 1, 2, 3, 9, 10, 11, 25, 40])] + [(3, text(12)), (20, None), (21, "rare")]
    rows = [(i, text(rng.randrange(60))) for i in range(40)]
    rows += [(100, items[7][1]), (101, "x " + items[8][1].upper() + " y"), (102, None), (103, ""), (104, "Rare-Rare?rare"), (None, items[6][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.contamination(docs(*rows).withColumn("spans", F.lit(0)), benchmark).collect()
    assert len(out) == len(rows)
    for (i, given), row in zip(rows, sorted(out, key=lambda r: [x[0] for x in rows].index(r.doc_id)), strict=True):
        n, hit, found = brute_force(given, items)
        assert (row.doc_id, row.n_words, row.n_hit) == (i, n, hit)
        assert {s.item_id for s in row.spans} == {str(f) for f in found}
        for span in row.spans:
            own = split(given)[span.doc_start : span.doc_start + span.n_words]
            assert any(own == split(t)[span.item_start : span.item_start + span.n_words] for k, t in items if str(k) == span.item_id)
    kept = {r.doc_id for r in decontamination.keep_clean(docs(*rows), benchmark).collect()}
    assert kept == {r.doc_id for r in out if not r.n_hit}


def test_spans_are_the_longest_matches(spark, docs):
    item = " ".join(f"t{k}" for k in range(30))
    benchmark = spark.createDataFrame([(5, item)], "item_id long, text string")
    found = decontamination.contamination(docs((1, "a b " + " ".join(item.split()[4:24]) + " c")), benchmark).first()
    assert [tuple(s) for s in found.spans] == [("5", 2, 4, 20)] and found.n_hit == 20


def test_contamination_without_rows(spark, docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    row = decontamination.contamination(docs((1, "some words")), nothing).first()
    assert (row.n_words, row.n_hit, row.spans) == (2, 0, [])
    assert decontamination.contamination(docs((1, "a")).limit(0), nothing).count() == 0
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
