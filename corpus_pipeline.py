"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Every stage works on all rows that the one before it kept, and learns only from those. Rows
are whole documents: an empty table passes through every stage, other columns stay beside
those of documents, and a stage decides alike on rows that are equal.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language_id, near_duplicates, quality_ranking, sentencepiece_viterbi
from tidemark.llm.common import held_out, stored, table
from tidemark.llm.queries import PIECE_MODEL


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with at least the operator's minimum score.

    Null and empty texts, and those without a letter, have no language and go.
    """
    return language_id.keep_identified(docs, ~held_out(F.col("doc_id")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking learnt from labelled ones predicts to be good.

    Documents without a label, or an id, are scored like others; null labels teach nothing.
    """
    return quality_ranking.keep_good(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Rows that repeat an id are one document. A row without an id goes where its copy has one.
    """
    return near_duplicates.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word in a window of the benchmark.

    Items without text hit nothing; ids of items, null or repeated, don't matter.
    """
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of what is left and whether they decode to it, beside the columns of documents.

    Where a column is called ``ids``, ``n_tokens`` or ``round_trip`` already, a new one takes
    a free name.
    """
    return sentencepiece_viterbi.with_round_trip(docs, public_tokenizers.path(PIECE_MODEL))


STAGES = [
    ("language ID", language),
    ("quality classifier", quality),
    ("MinHash near-dedup", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding", encode),
]

#: The models of the first two stages and the segmentation of the last are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
