"""SentencePiece encoding and decoding by an Aho-Corasick automaton and a Viterbi pass.

The automaton holds every piece. It reads a text once; at each position its output links
name all pieces that end there, and each relaxes the best score of that position. The best
segmentation is the one with the largest sum of piece scores; among equal sums the one
whose last piece begins first wins, at every position. A character in no piece costs ten
less than the lowest score and is written as its UTF-8 bytes' pieces.

This is the unigram rule on the scores of the model file. The public model at hand was
made for merging (BPE), whose own rule may segment a word differently; both decode to the
same text.

Pieces hold the space mark only at their beginning, so the best path through a text is the
best paths through its words one after the other. Words are therefore segmented apart, each
distinct word once per batch, and short ones are remembered within a bound.
"""

from __future__ import annotations

import functools
import re
import struct
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SMALL_BATCH_BYTES, as_lists, bounded_batches, by_bytes, stored, texts, unlike
from tidemark.llm.token_counts import Remembered

SPACE = "▁"
MARK = SPACE.encode()
#: An unknown character scores so much less than the lowest piece.
UNKNOWN_PENALTY = 10.0
KEEP_CHARS = 48
#: Words remembered per Python worker, about 200 bytes each.
REMEMBERED = 200_000
#: Bytes of text that are taken apart into words at once.
PART_BYTES = 1 << 18
_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*")
_WORDS_AND_LINES = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")


class Written:
    """What each piece of a model file is written as: all that decoding takes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.written = [
            b"" if model.is_control(i) else bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.encode()
            for i, p in zip(ids, map(model.id_to_piece, ids))
        ]

        plain = [w.replace(MARK, b" ") for w in self.written]
        front = [w.removeprefix(MARK).replace(MARK, b" ") for w in self.written]
        #: Pieces with spaces for marks, and after them the same as first pieces of a text.
        self.spaced = pa.array(plain + front, pa.large_binary())

    def decode(self, ids: list[int]) -> str:
        """The text of ids: byte pieces joined to characters, the mark in front dropped."""
        text = b"".join(map(self.written.__getitem__, ids)).decode("utf-8", "replace")
        return text.removeprefix(SPACE).replace(SPACE, " ")

    def decode_all(self, lists: pa.Array) -> pa.Array:
        """The text of each list of ids, empty for a null one; all lists at once.

        One by one where bytes pieces form a mark, or no character.
        """
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        ids = flat.astype(np.int64)
        ids[bounds[:-1][lengths > 0]] += len(self.written)
        taken = self.spaced.take(pa.array(ids))
        _, ends, data = taken.buffers()
        if len(ids) and data is not None:
            cuts = np.frombuffer(ends, np.int64, len(ids) + 1)[bounds]
            text = pa.LargeStringArray.from_buffers(len(lists), pa.py_buffer(cuts), data)
            if MARK not in data.to_pybytes() and _is_text(text):
                return text.cast(pa.string())
        one_by_one = (self.decode(flat[a:b].tolist()) for a, b in zip(bounds, bounds[1:]))
        return pa.array(one_by_one, pa.string())


def _is_text(array: pa.Array) -> bool:
    try:
        array.validate(full=True)
    except pa.ArrowInvalid:
        return False
    return True


class Pieces:
    """Pieces of a model file and the automaton over them, for both directions.

    What decoding takes is loaded when it is asked for, once in a process.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.path, pieces = path, [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.unknown_id = model.unk_id()
        self.bytes_ = {}
        self.automaton = ahocorasick.Automaton()
        lowest = 0.0
        for i, piece in enumerate(pieces):
            if model.is_byte(i):
                self.bytes_[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                score = model.get_score(i)
                lowest = min(lowest, score)
                self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self.unknown_score = lowest - UNKNOWN_PENALTY
        #: Words may be segmented apart only if no piece goes on over the start of a word.
        self.by_words = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        #: Nor if none holds a line break, which then stands alone too.
        self.by_lines = not any("\n" in p for p in pieces)

    def words(self, text: str) -> list[str]:
        """Parts of ``text``, spaces as marks and one in front, that segment on their own."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        if not self.by_words:
            return [marked]
        return (_WORDS_AND_LINES if self.by_lines else _WORDS).findall(marked)

    @property
    def written(self) -> list[bytes]:
        return written(self.path).written

    def decode(self, ids: list[int]) -> str:
        return written(self.path).decode(ids)

    def segment(self, word: str) -> list[int]:
        """The ids of the best segmentation of ``word``, where spaces are marks already."""
        n = len(word)
        # By end position: best score, where its last piece begins, and that piece.
        best, begins, last = [0.0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        unknown_score, end = self.unknown_score, 0
        for at, (length, score, i) in self.automaton.iter(word):
            if at >= end:
                # Fall back to an unknown character where no piece ends.
                while end < at:
                    end += 1
                    best[end], begins[end] = best[end - 1] + unknown_score, end - 1
                end = at + 1
                begin = end - length
                total = best[begin] + score
                # The longest piece that ends here comes first. The character alone may be
                # unknown; where it is a piece, that piece comes later and scores more.
                if length == 1 or total >= best[at] + unknown_score:
                    best[end], begins[end], last[end] = total, begin, i
                else:
                    best[end], begins[end] = best[at] + unknown_score, at
                    last[end] = self.unknown_id
            else:
                begin = end - length
                total = best[begin] + score
                if total > best[end] or (total == best[end] and begin < begins[end]):
                    best[end], begins[end], last[end] = total, begin, i
        while end < n:
            end += 1
            best[end], begins[end] = best[end - 1] + unknown_score, end - 1
        ids, end = [], n
        while end:
            begin, i = begins[end], last[end]
            if i < 0 or i == self.unknown_id:
                found = [self.bytes_.get(b, self.unknown_id) for b in word[begin:end].encode()]
                ids += reversed(found)
            else:
                ids.append(i)
            end = begin
        return ids[::-1]


@functools.lru_cache(1)
def load(path: str) -> Pieces:
    return Pieces(path)


@functools.lru_cache(1)
def written(path: str) -> Written:
    return Written(path)


@functools.lru_cache(1)
def encoder(path: str, remembered: int = REMEMBERED) -> Callable[[list[bytes | None]], list[bytes]]:
    """A function from texts to their ids, packed as little-endian 32-bit integers.

    Kept between the tasks of a worker, with what it remembers.
    """
    pieces, known = load(path), Remembered(remembered)

    def encode(batch: list[bytes | None]) -> list[bytes]:
        out: list[bytes] = []
        for part in by_bytes((t or b"" for t in batch), PART_BYTES):
            words = [pieces.words(t.decode()) for t in part]
            used = set().union(*words)
            fresh = sorted(known.without(used))
            for word in fresh:
                ids = pieces.segment(word)
                known[word] = struct.pack(f"<{len(ids)}i", *ids)
            out += [b"".join(map(known.__getitem__, w)) for w in words]
            known.trim([w for w in fresh if len(w) > KEEP_CHARS], used)
        return out

    return encode


def encode_pieces(text: Column, path: str) -> Column:
    """The piece ids of each text; null for a null text, none for an empty one."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(path)
        for batch in batches:
            given = texts(batch)
            yield as_lists([None if t is None else p for t, p in zip(given, encode(given), strict=True)])

    return ids(text)


def decode_pieces(ids: Column, path: str) -> Column:
    """The text of piece ids; null for null ids."""

    @F.arrow_udf(T.StringType())
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = written(path)
        for batch in batches:
            out = pieces.decode_all(batch)
            yield pc.if_else(batch.is_null(), pa.scalar(None, pa.string()), out)

    return text(ids)


def same_text(text: Column, decoded: Column) -> Column:
    """Whether decoding gave the text again, a space mark in the text counting as a space."""
    return F.translate(text, SPACE, " ").eqNullSafe(decoded)


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text and decode it again: ``doc_id, n_tokens, ids, round_trip``.

    ``round_trip`` tells whether decoding gives the text again, a space mark in the text
    counting as a space. A null text has null ids, no tokens and a true round trip; an
    empty one has no ids. Repeated rows and null ids of documents are rows like any other;
    columns that are not named are not read. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession, SMALL_BATCH_BYTES)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("ids", encode_pieces(F.col("text"), path))
    rows = rows.withColumn("decoded", decode_pieces(F.col("ids"), path))
    return rows.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
        "ids",
        same_text(F.col("text"), F.col("decoded")).alias("round_trip"),
    )


def with_pieces(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``n_tokens`` added, under free names where those are taken."""
    bounded_batches(docs.sparkSession, SMALL_BATCH_BYTES)
    ids, n_tokens = unlike(docs, "ids"), unlike(docs, "n_tokens")
    encoded = docs.withColumn(ids, encode_pieces(F.col(text), path))
    return encoded.withColumn(n_tokens, F.coalesce(F.size(ids), F.lit(0)).cast("long"))


def with_round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and, decoded from the ids, ``round_trip`` added.

    As ``encode_documents`` has them, under free names where those are taken. Ids are written
    before they are decoded, so that a task needs one Python worker at a time.
    """
    ids, round_trip = unlike(docs, "ids"), unlike(docs, "round_trip")
    rows = stored(with_pieces(docs, path, text), "pieces")
    decoded = unlike(rows, "decoded")
    rows = rows.withColumn(decoded, decode_pieces(F.col(ids), path))
    return rows.withColumn(round_trip, same_text(F.col(text), F.col(decoded))).drop(decoded)
