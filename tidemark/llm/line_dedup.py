"""Line de-duplication: lines found in many documents go, the others stay in their places.

Lines are exploded, normalised and hashed, the documents of each hash are counted, and lines
over the threshold are dropped, all with built-in expressions. What moves for it are hashes
and positions. A text moves once, to meet the positions that it loses.

A line of a third of all documents is one row per task in the count. Its occurrences are
found by a broadcast: of all lines over the threshold where these are few, else of those that
make up more than a ``HOT``-th of all occurrences, which can't be more than ``HOT``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

BLANKS = " \t\n\v\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_DOCS = 10
MIN_CHARS = 1
#: So many frequent lines, 16 bytes each, are broadcast whole.
BROADCAST_LINES = 500_000
HOT = 100_000


def normalised(line: Column) -> Column:
    """The line without blanks at its ends, A-Z as a-z."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def line_keys(text: Column) -> Column:
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), normalised)


def _print(*columns: str) -> list[Column]:
    """128 bits of what the columns hold."""
    return [F.xxhash64(F.lit(k), *columns).alias(f"{'_'.join(columns)}_{k}") for k in (1, 2)]


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``key_1, key_2, n`` of the lines of ``text`` that at least ``min_docs`` rows hold."""
    found = docs.select(F.explode(F.array_distinct(line_keys(F.col("text")))).alias("key"))
    found = found.filter(F.char_length("key") >= min_chars).groupBy(*_print("key"))
    return found.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs)


def _among(places: DataFrame, frequent: DataFrame) -> DataFrame:
    """The rows of ``places`` whose key is in ``frequent``; no key is taken to one task."""
    on = ["key_1", "key_2"]
    lines, total = frequent.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if lines <= BROADCAST_LINES:
        return places.join(F.broadcast(frequent.select(on)), on, "left_semi")
    hot = frequent.filter(F.col("n") * HOT > total).select(*on, F.lit(True).alias("hot"))
    rest = frequent.filter(F.col("n") * HOT <= total).select(F.col("key_1").alias("spread"), "key_2", F.lit(False).alias("hot"))
    marked = places.join(F.broadcast(hot), on, "left")
    # A hot line is known by now; it travels by its place, so that it doesn't meet its like.
    spread = F.when(F.col("hot"), F.xxhash64("doc_1", "pos")).otherwise(F.col("key_1"))
    marked = marked.withColumns({"spread": spread, "hot": F.coalesce("hot", F.lit(False))})
    rest = rest.withColumn("found", F.lit(True))
    joined = marked.join(rest, ["spread", "key_2", "hot"], "left")
    return joined.filter(F.col("hot") | F.col("found")).select(places.columns)


def drop_frequent_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text`` of every row of ``docs``.

    A text is split at newlines. A line's key is the line without blanks at its ends and
    with A-Z as a-z; keys of at least ``min_chars`` code points that at least ``min_docs``
    rows hold lose all their lines. Each row counts as a document, also where ids or whole
    rows repeat or the id is null. A null or empty text is one empty line, which has no key
    to lose it by unless ``min_chars`` is 0. An empty table gives no rows; columns that are
    not named are not read.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    frequent = stored(frequent_lines(docs, min_docs, min_chars), "frequent-lines")
    # Equal rows lose the same lines, so a row is known by what it holds.
    own = [c.alias(f"doc_{k}") for k, c in enumerate(_print("doc_id", "text"), 1)]
    places = docs.select(*own, F.posexplode(line_keys(F.col("text"))).alias("pos", "key"))
    places = places.filter(F.char_length("key") >= min_chars).select("doc_1", "doc_2", "pos", *_print("key"))
    gone = _among(places, frequent).groupBy("doc_1", "doc_2").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    rows = docs.select("*", *own).join(gone, ["doc_1", "doc_2"], "left")
    rows = rows.select("doc_id", "gone", F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"))
    # What stays are the stretches between one dropped line and the next.
    ends = F.concat(F.array(F.lit(-1)), F.coalesce("gone", F.array().cast("array<int>")), F.array(F.size("lines")))
    rows = rows.select("doc_id", "lines", ends.alias("ends"))
    stretch = lambda k: F.slice("lines", F.get("ends", k) + 2, F.get("ends", k + 1) - F.get("ends", k) - 1)
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("ends") - 2), stretch))
    return rows.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("ends") - 2).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept_text"),
    )
