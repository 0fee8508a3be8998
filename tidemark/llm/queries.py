"""The registered queries of this subpackage, each over its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    conversation_trie,
    decontamination,
    hnsw,
    language_id,
    lexical_search,
    line_dedup,
    near_duplicates,
    oracles,
    quality_ranking,
    sentencepiece_viterbi,
    sharding,
    token_counts,
    token_files,
    warc,
)
from tidemark.llm.common import held_out, stored, table
from tidemark.session import scratch_dir

COUNT_TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2_048
FILE_TOKENIZER = "byte_bpe_50k.json"
FILE_END_ID = 0
PIECE_MODEL = "piece_bpe_32k.model"
SHARDS = 16
NEIGHBOURS = 20
HITS = 10
LINE_DOCS = 10


def op1_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ranked = quality_ranking.rank_quality(docs, labels, ~held_out(F.col("doc_id")))
    return ranked.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op3_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.interleaved_shards(table(spark, sf_dir, "documents"), SHARDS)
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def op4_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item_id"])))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), out)
    # Assembly goes through the records three times; archives are unpacked once.
    records = stored(warc.read_archives(spark, out, payloads=False), "warc-records")
    found = stored(warc.transactions(records), "transactions")
    rows = found.select(
        F.col("capture_id"),
        F.col("metadata.fields")["page-id"].cast("long").alias("page_id"),
        "capture.payload_bytes",
        F.coalesce("capture.declared_digest", "capture.payload_digest").alias("declared"),
        F.col("capture.payload_digest").alias("payload_digest"),
        F.col("capture.type").alias("record_type"),
        F.col("capture.refers_to").alias("to"),
    )
    # What a revisit doesn't hold is that of the response which it refers to.
    full = rows.filter("record_type = 'response'").select(
        F.col("capture_id").alias("to"),
        F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("full_bytes"),
        F.col("payload_digest").alias("full_digest"),
    )
    own = F.col("record_type") == "response"
    return rows.join(full, "to", "left").select(
        "page_id",
        F.when(own, F.col("payload_bytes")).otherwise(F.col("full_bytes")).alias("payload_bytes"),
        F.when(own, F.col("payload_digest")).otherwise(F.col("full_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
        (F.col("declared") == F.when(own, F.col("payload_digest")).otherwise(F.col("full_digest"))).alias("digest_holds"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(COUNT_TOKENIZER)
    return token_counts.token_counts(table(spark, sf_dir, "documents"), path, TOKEN_LIMIT)


def op7_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, NEIGHBOURS)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, out = public_tokenizers.path(FILE_TOKENIZER), scratch_dir(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, out, FILE_END_ID)
    rows = token_files.read_token_files(spark, out)
    return rows.select("doc_id", "start", "n_tokens", token_files.ids_crc32(F.col("ids")).alias("ids_crc32"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(PIECE_MODEL)
    return sentencepiece_viterbi.encode_documents(table(spark, sf_dir, "documents"), path)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, ~held_out(F.col("doc_id")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"), HITS)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_frequent_lines(table(spark, sf_dir, "documents"), LINE_DOCS)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.numbered(table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(*conversation_trie.rebuilt(turns))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_ranking,
        op2_minhash_near_dedup,
        op3_interleaved_shards,
        op4_suffix_decontamination,
        op5_warc_transactions,
        op6_token_counts,
        op7_hnsw_neighbours,
        op8_token_files,
        op9_sentencepiece,
        op10_language_id,
        op11_lexical_search,
        op12_line_dedup,
        op13_conversation_trie,
    )
}
ORACLES = {
    "op2_minhash_near_dedup": oracles.NEAR_DUPLICATES,
    "op3_interleaved_shards": oracles.SHARDS,
    "op4_suffix_decontamination": oracles.CONTAMINATION,
    "op5_warc_transactions": oracles.CAPTURES,
    "op11_lexical_search": oracles.SEARCH,
    "op12_line_dedup": oracles.LINES,
    "op13_conversation_trie": oracles.TRIE,
}
