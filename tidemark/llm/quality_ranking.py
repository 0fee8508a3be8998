"""Quality by Bradley-Terry pairwise ranking.

A preference pair is a document of label 1 over one of label 0. The model gives a document
the score w.x, and the first of a pair wins with probability sigmoid(w.x1 - w.x0): logistic
loss on differences of features, without an intercept. The threshold is the quantile of the
scores of labelled documents at the share of label 0 among them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, stored, texts

#: Preference pairs per document of label 0, spread evenly over those of label 1.
PAIRS_PER_NEGATIVE = 8
#: The score at which a document is predicted to be good.
CUT = 0.3
#: About the largest number of labelled documents that a model is fitted on, taken by a hash
#: of the id within each label; all of them where there are fewer. The threshold is that of all.
FIT_ROWS = 200_000

_CLASSES = {
    "letter": bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)),
    "upper": bytes(range(65, 91)),
    "digit": b"0123456789",
    "space": b" \t\n\v\f\r",
    "line": b"\n",
    "stop": b".!?",
    "comma": b",;:",
    "exclaim": b"!?",
    "bar": b"|",
    "odd": b"#$%&*+=<>@^_`~|\\/{}[]",
    "quote": b"\"'()",
}
_CLASS_OF = np.zeros((256, len(_CLASSES)))
for _k, _members in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_members), _k] = 1


def features(text: bytes | None) -> list[float]:
    """Shares of kinds of characters, repetition, and word and line shapes, of a whole text."""
    data = text or b""
    n = max(len(data), 1)
    shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASS_OF / n
    words = data.split()
    m = max(len(words), 1)
    distinct = len(set(words))
    repeats = sum(map(bytes.__eq__, words[1:], words)) / m
    lines = data.split(b"\n")
    again = 1 - len(set(lines)) / len(lines)
    mean = (len(data) - len(words)) / m
    # Small shares matter on a logarithmic scale: a text may be spoilt in one place only.
    return [
        1.0 if data else 0.0,
        math.log1p(len(data)),
        math.log1p(m),
        min(mean, 50.0),
        distinct / m,
        math.log(distinct + 1.0) / math.log(m + 1.0),
        repeats,
        math.log(repeats + 1e-3),
        again,
        math.log(len(lines) / n + 1e-4),
        *shares,
        *np.log(shares + 1e-4),
    ]


N_FEATURES = len(features(b""))


def text_features(text: Column) -> Column:
    """The features of each text; a null text has those of an empty one."""

    @F.arrow_udf(T.ArrayType(T.DoubleType(), False))
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = np.asarray([features(t) for t in texts(batch)], float).reshape(-1)
            ends = np.arange(len(batch) + 1, dtype=np.int32) * N_FEATURES
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(values))

    return of(text)


@dataclass(frozen=True)
class Ranking:
    """Weights, and the score at the threshold."""

    weights: tuple[float, ...]
    threshold: float

    def margin(self, x: Column) -> Column:
        terms = F.zip_with(x, F.array(*map(F.lit, self.weights)), lambda a, b: a * b)
        return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)

    def score(self, x: Column) -> Column:
        """0 to 1, ``CUT`` at the threshold."""
        shift = math.log(CUT / (1 - CUT)) - self.threshold
        return 1 / (1 + F.exp(-(self.margin(x) + shift)))


def preference_pairs(rows: DataFrame) -> DataFrame:
    """Differences of features, better minus worse, of pairs dealt out by hashes.

    Each document of label 0 draws several slots, each of label 1 has one; those in one
    slot are paired. There are as many slots as documents of label 1, so a slot holds few
    rows, and the number of pairs is a multiple of that of label 0.
    """
    slots = max(rows.filter("label = 1").count(), 1)
    slot = lambda *k: F.pmod(F.xxhash64("doc_id", *k), F.lit(slots))
    good = rows.filter("label = 1").select(slot().alias("slot"), F.col("x").alias("better"))
    bad = rows.filter("label = 0").select("doc_id", F.col("x").alias("worse"), F.explode(F.sequence(F.lit(1), F.lit(PAIRS_PER_NEGATIVE))).alias("draw"))
    bad = bad.select(slot("draw").alias("slot"), "worse", (F.xxhash64("doc_id", "draw") % 2 == 0).alias("flip"))
    pairs = good.join(bad, "slot")
    sign = F.when(F.col("flip"), -1.0).otherwise(1.0)
    return pairs.select(
        F.zip_with("better", "worse", lambda a, b: (a - b)).alias("d"), sign.alias("sign")
    ).select(
        array_to_vector(F.transform("d", lambda v: v * F.col("sign"))).alias("features"),
        (F.col("sign") > 0).cast("double").alias("label"),
    )


def fit_sample(rows: DataFrame, counts: dict[int, int], fit_rows: int) -> DataFrame:
    """About ``fit_rows`` of more labelled rows; half of them for each label, the rarer one whole if it is less.

    By ranges of a hash of the id, so no row moves. The id of the lowest hash of a label is
    always there: no label can be missing.
    """
    rarer = min(counts, key=counts.get)
    quota = {rarer: min(counts[rarer], fit_rows // 2)}
    quota[1 - rarer] = fit_rows - quota[rarer]
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11)
    lowest = dict(rows.groupBy("label").agg(F.min(place)).collect())
    upto = {k: max(lowest[k], int(min(1.0, quota[k] / n) * 2**53)) for k, n in counts.items()}
    return rows.filter(place <= F.when(F.col("label") == 0, upto[0]).otherwise(upto[1]))


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS) -> Ranking:
    """A ranking from ``doc_id, x, label``; labels other than 0 and 1 are left out.

    Where one of the labels is missing there is nothing to prefer: all weights are 0, and
    every document scores above the cut if label 1 is there or no label at all, else below.
    """
    rows = rows.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    rows = stored(rows, "quality-teach")  # read for counts, both sides of pairs, and scores
    total, bad = rows.agg(F.count("*"), F.count_if(F.col("label") == 0)).first()
    if bad in (0, total):
        return Ranking((0.0,) * N_FEATURES, -1.0 if bad == 0 else 1.0)
    taught = rows
    if total > fit_rows:
        taught = stored(fit_sample(rows, {0: bad, 1: total - bad}, fit_rows), "quality-fit")
    model = LogisticRegression(fitIntercept=False, regParam=1e-4, maxIter=60, aggregationDepth=2)
    fitted = model.fit(preference_pairs(taught))
    ranking = Ranking(tuple(map(float, fitted.coefficients)), 0.0)
    scores = rows.select(ranking.margin(F.col("x")).alias("s"))
    at = scores.agg(F.percentile_approx("s", bad / total, 100_000)).first()[0]
    # Halfway to the next larger score, so that the row at the quantile lies below.
    above = scores.filter(F.col("s") > at).agg(F.min("s")).first()[0]
    return Ranking(ranking.weights, float(at if above is None else (at + above) / 2))


def rank_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """``docs`` as ``doc_id, learn, score, predicted``, one row per row.

    Only labelled rows for which ``learn_from`` holds teach the model. Null and empty texts
    are scored like others, by the features of no text. A document labelled twice teaches
    with each label; an empty table gives no rows. Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(learn_from, F.lit(False)).alias("learn"),
        text_features(F.col(text)).alias("x"),
    )
    rows = stored(rows, "quality-features")
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
    ranking = fit(rows.filter("learn").join(known, "doc_id").select("doc_id", "x", "label"))
    return scored(rows, ranking)


def scored(rows: DataFrame, ranking: Ranking) -> DataFrame:
    score = ranking.score(F.col("x"))
    return rows.withColumn("score", score).withColumn("predicted", (F.col("score") >= CUT).cast("int")).drop("x")


def keep_good(docs: DataFrame, labels: DataFrame, learn_from: Column) -> DataFrame:
    """The rows of ``docs`` that a ranking learnt from them predicts to be good."""
    bounded_batches(docs.sparkSession)
    known = labels.select("doc_id", F.col("quality").alias("label"))
    # Features move to their labels, texts don't.
    teach = docs.filter(learn_from).select("doc_id", text_features(F.col("text")).alias("x"))
    teach = stored(teach, "quality-features")
    ranking = fit(teach.join(known, "doc_id").select("doc_id", "x", "label"))
    return docs.filter(ranking.score(text_features(F.col("text"))) >= CUT)
