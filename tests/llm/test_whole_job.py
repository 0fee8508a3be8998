"""That operators do the whole job where samples, repeats or scores decide."""

from __future__ import annotations

import random

import corpus_pipeline
from pyspark.sql import functions as F

from tidemark.llm import language_id, quality_ranking
from tidemark.llm import sentencepiece_viterbi as sp
from tidemark.llm.common import held_out

VOCABULARY = {
    "en": "the and with that from this have were they which",
    "de": "der und nicht eine auch sich wird durch über schön",
    "fr": "les des dans pour avec elle être nous très même",
    "es": "los que para con una está niño más también año",
}


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."


def spoken(n=160):
    rng = random.Random(8)
    langs = list(VOCABULARY)
    return [(i, prose(rng, VOCABULARY[langs[i % 4]].split(), 30), langs[i % 4]) for i in range(n)]


def test_letters_alone_do_not_identify_a_language(docs):
    odd = [
        (900, "Все люди рождаются свободными и равными в своем достоинстве и правах. " * 5, None),
        (901, "| a | 12 | 33 | b |\n| 4 | x | 9.1 | 3 |\n" * 20, "en"),
        (902, "12 .. 34", "en"),
        (903, None, "en"),
    ]
    teach = ~held_out(F.col("doc_id")) & (F.col("doc_id") < 900)
    kept = {r.doc_id for r in language_id.keep_identified(docs(*spoken(), *odd), teach).collect()}
    assert kept == set(range(160))


def taught(docs, label, n=2000):
    """``doc_id, x, label``; every fourth text is spoilt."""
    rng = random.Random(5)
    words = ["tree", "river", "stone", "green", "walks", "under", "light", "the", "a", "of"]
    rows = []
    for i in range(n):
        text = prose(rng, words, rng.randrange(5, 60))
        rows.append((i, text if i % 4 else text.upper().replace(" ", "!! ")))
    x = docs(*rows).withColumn("x", quality_ranking.text_features(F.col("text")))
    return x.select("doc_id", "x", label.alias("label"))


def test_quality_threshold_is_that_of_all_labelled_rows(docs):
    # A tenth of the labels is wrong, so scores overlap where the threshold is.
    label = F.when(F.col("doc_id") % 10 == 3, F.col("doc_id") % 4 == 0).otherwise(F.col("doc_id") % 4 != 0)
    rows = taught(docs, label.cast("int")).cache()
    ranking = quality_ranking.fit(rows, 60)
    below = rows.filter(ranking.margin(F.col("x")) < ranking.threshold).count()
    assert abs(below - rows.filter("label = 0").count()) <= 1


def test_a_rare_label_teaches_though_rows_are_sampled(docs):
    rows = taught(docs, F.when(F.col("doc_id").isin(400, 1200), 0).otherwise(1))
    rows = rows.filter("doc_id % 4 != 0 or doc_id in (400, 1200)").cache()
    ranking = quality_ranking.fit(rows, 40)
    scores = {r.doc_id: r.m for r in rows.select("doc_id", ranking.margin(F.col("x")).alias("m")).collect()}
    assert sorted(sorted(scores, key=scores.get)[:2]) == [400, 1200]


def test_last_stage_decodes(spark, docs, monkeypatch):
    df = docs((1, "one two"), (2, None), (3, ""), (4, "a▁b")).withColumn("decoded", F.lit("mine"))
    out = corpus_pipeline.encode(spark, df, "")
    assert out.columns == [*df.columns, "ids", "n_tokens", "round_trip"]
    assert {(r.doc_id, r.n_tokens > 0, r.round_trip, r.decoded) for r in out.collect()} == {
        (1, True, True, "mine"),
        (2, False, True, "mine"),
        (3, False, True, "mine"),
        (4, True, True, "mine"),
    }
    monkeypatch.setattr(sp, "decode_pieces", lambda ids, path: F.lit("other"))
    assert not corpus_pipeline.encode(spark, docs((1, "one")), "").first().round_trip
