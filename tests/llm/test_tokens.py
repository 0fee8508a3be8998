"""Counts, token files and piece ids against the libraries on whole texts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.llm import sentencepiece_viterbi as sp
from tidemark.llm import token_counts, token_files
from tidemark.session import scratch_dir

COUNTS = public_tokenizers.path("word_bpe_49k.json")
FILES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    "",
    " ",
    "\n\n",
    "Plain words, and more.",
    "  two  blanks\t a tab\n\n new lines \n",
    "it's we'll don't 'tis ’s",
    "special <|endoftext|> and<|endoftext|>inside <|startoftext|>",
    "Ünïcödé ÀÖ×ø é́ñ… 日本語 🦀 a​b \x1c c\xa0d e",
    "12 345a 6.7 x@y.z (a) [b] {c} #$%&*",
    "ends with blank ",
    "x" * 5_000,
    "word " * 3_000,
]


def fuzz(n, seed):
    rng = random.Random(seed)
    alphabet = "ab Z'é.\n\t,1 　<|>!"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(n)]


ALL = TEXTS + fuzz(300, 3)


@pytest.mark.parametrize("remembered", [0, 300_000])
def test_counts_are_the_librarys(remembered):
    count = token_counts.counter(COUNTS, remembered)
    tokenizer = token_counts.load(COUNTS)
    want = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in ALL]
    assert count([t.encode() for t in ALL]) == want
    assert count([None]) == [0]


@pytest.mark.parametrize("remembered", [0, 300_000])
def test_ids_are_the_librarys(remembered):
    encode = token_files.encoder(FILES, remembered)
    tokenizer = token_counts.load(FILES)
    want = [np.asarray(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ALL]
    assert encode([t.encode() for t in ALL]) == want


def test_segments_are_learnt_where_they_are_looked_up():
    asked, long_one = [], "x" * 100
    known = token_files.Segments(3, lambda s: asked.append(s) or s.encode())
    assert b"".join(map(known.__getitem__, ["a", "b", "a", long_one])) == b"aba" + long_one.encode()
    assert asked == ["a", "b", long_one]
    known.trim_after(lambda: pytest.fail("nothing has to go"))
    assert list(known) == ["a", "b"] and not known.long_ones
    assert [known[s] for s in "acd"] == [b"a", b"c", b"d"]
    known.trim_after(lambda: {"a"})
    assert list(known) == ["a", "d"]


def test_distinct_segments_are_looked_up_once(monkeypatch):
    asked = []

    class Watched(token_files.Segments):
        def __getitem__(self, segment):
            asked.append(segment)
            return super().__getitem__(segment)

    monkeypatch.setattr(token_files, "Segments", Watched)
    encode = token_files.encoder.__wrapped__(FILES, 300_000)
    text = "one two two\none two " + "one two " * 500 + "end"
    ids = np.asarray(token_counts.load(FILES).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert encode([text.encode(), None, text.encode()]) == [ids, b"", ids]
    assert len(asked) <= 5


def test_segments_of_a_column_are_those_of_each_text():
    blanks = [chr(c) for c in range(0x3100) if chr(c).isspace() or chr(c) in "\u180e\u200b\u2060\x00"]
    odd = [t for b in blanks for t in (f"a{b}b c\nd", f"{b}a b", f"a b{b}", f"a {b}b", f"a\n{b}b")]
    for texts in (ALL + odd, ["a b\nc"], ["a  b"], [""], []):
        found = token_files.segments(pa.array(texts, pa.large_string())).to_pylist()
        assert found == [token_files._cut(t) for t in texts]
    encode, tokenizer = token_files.encoder(FILES), token_counts.load(FILES)
    want = [np.asarray(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in odd]
    assert encode([t.encode() for t in odd]) == want


def test_count_query_columns(docs):
    df = docs((1, "one two"), (None, "three"), (2, None), (1, "one two")).withColumn("n_tokens", F.lit("mine"))
    rows = token_counts.token_counts(df, COUNTS, 1).collect()
    assert [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows] == [
        (1, 7, 2, True),
        (None, 5, 1, False),
        (2, 0, 0, False),
        (1, 7, 2, True),
    ]
    assert token_counts.token_counts(df.limit(0), COUNTS, 1).count() == 0


def test_token_files_round_trip(spark, docs):
    texts = dict(enumerate(TEXTS))
    rows = [(9 * k % 31, t) for k, t in texts.items()] + [(40, None), (None, "no id"), (41, "same"), (41, "same")]
    out = scratch_dir(spark, "tokens")
    token_files.write_token_files(docs(*rows).repartition(3), FILES, out, 0)
    stored = token_files.read_token_files(spark, out)
    got = stored.withColumn("crc", token_files.ids_crc32(F.col("ids"))).orderBy("start").collect()
    tokenizer, start = token_counts.load(FILES), 0
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [i for i, _ in ordered]
    for row, (_, text) in zip(got, ordered, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert row.ids == ids and row.start == start and row.n_tokens == len(ids)
        assert row.crc == zlib.crc32(np.asarray(ids, "<u4").tobytes())
        start += len(ids)


def test_token_files_have_the_layout(spark, docs, tmp_path):
    out = str(tmp_path / "tokens")
    token_files.write_token_files(docs(*enumerate(ALL)), FILES, out, 0)
    part = pq.ParquetFile(max((tmp_path / "tokens").glob("part-*"), key=lambda p: p.stat().st_size))
    group = part.metadata.row_group(0)
    columns = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
    assert all(c.has_offset_index and c.has_column_index for c in columns.values())


def test_empty_table_writes_no_rows(spark, docs):
    out = scratch_dir(spark, "tokens")
    token_files.write_token_files(docs((1, "a")).limit(0), FILES, out, 0)
    assert token_files.read_token_files(spark, out).count() == 0


@pytest.fixture(scope="module")
def pieces():
    return sp.Pieces(PIECES)


def best_score(pieces, word):
    """The largest sum of scores over all ways to cut ``word``, by plain recursion on ends."""
    by_piece = {p: s for p, (_, s, _) in pieces.automaton.items()}
    best = [0.0]
    for end in range(1, len(word) + 1):
        ways = [best[a] + by_piece[word[a:end]] for a in range(end) if word[a:end] in by_piece]
        best.append(max([*ways, best[end - 1] + pieces.unknown_score]))
    return best[-1]


def score_of(pieces, ids):
    by_id = {i: s for _, (_, s, i) in pieces.automaton.items()}
    total, run = 0.0, 0
    for i in ids:
        if i in by_id:
            total += by_id[i]
        elif len(pieces.written[i]) == 1 and pieces.written[i][0] & 0xC0 != 0x80:
            total += pieces.unknown_score  # the first byte of an unknown character
    return total


def test_segmentation_is_the_best(pieces):
    for text in [t for t in ALL if len(t) < 200]:
        for word in pieces.words(text):
            assert score_of(pieces, pieces.segment(word)) == pytest.approx(best_score(pieces, word), rel=1e-12)


def test_words_apart_score_like_the_whole(pieces):
    for text in [t for t in ALL if 0 < len(t) < 200]:
        whole = sp.SPACE + text.replace(" ", sp.SPACE)
        apart = sum(best_score(pieces, w) for w in pieces.words(text))
        assert apart == pytest.approx(best_score(pieces, whole), rel=1e-12)


def test_round_trip_and_library_decoding(pieces):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encode = sp.encoder(PIECES)
    for text in ALL:
        ids = np.frombuffer(encode([text.encode()])[0], "<i4").tolist()
        assert pieces.decode(ids) == text
        assert library.decode(ids) == text


def test_encode_documents_handles_nulls(docs):
    df = docs((1, "one"), (None, None), (2, ""), (3, "a▁b")).withColumn("ids", F.lit(1))
    rows = sp.encode_documents(df, PIECES).collect()
    assert [(r.doc_id, r.n_tokens > 0, r.ids is None, r.round_trip) for r in rows] == [
        (1, True, False, True),
        (None, False, True, True),
        (2, False, False, True),
        (3, True, False, True),
    ]
    assert set(sp.with_pieces(df, PIECES).columns) == {*df.columns, "ids_0", "n_tokens"}
    assert sp.encode_documents(df.limit(0), PIECES).count() == 0


def test_what_decoding_takes_is_loaded_once():
    assert sp.load(PIECES).written is sp.written(PIECES).written
    assert "written" not in vars(sp.load(PIECES))
