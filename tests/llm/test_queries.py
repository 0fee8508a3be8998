"""The registered queries at the smallest scale, and the pipeline."""

from __future__ import annotations

import pathlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.check_queries import compare, connect
from tests.llm.test_near_duplicates import brute_force as groups
from tests.llm.test_selection import brute_force as contaminated
from tidemark.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test data")

COLUMNS = {
    "op1": "doc_id held_out score predicted",
    "op2": "doc_id n_shingles component_id kept",
    "op3": "doc_id size text_crc32 law shard slot grown_shard",
    "op4": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op5": "page_id payload_bytes payload_digest record_type refers_to",
    "op6": "doc_id n_bytes n_tokens over_limit",
    "op7": "query_id rank vec_id score",
    "op8": "doc_id start n_tokens ids_crc32",
    "op9": "doc_id n_tokens ids round_trip",
    "op10": "doc_id held_out lang_pred score",
    "op11": "item_id rank doc_id score",
    "op12": "doc_id n_lines n_dropped kept_sha256",
    "op13": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
}


def test_all_are_registered():
    assert {q.split("_")[0] for q in QUERIES} == set(COLUMNS)
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(QUERIES) and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    wanted = COLUMNS[name.split("_")[0]].split()
    assert df.columns[: len(wanted)] == wanted
    assert df.count() == {"op5": 50, "op7": 500, "op11": 400, "op13": 34}.get(name.split("_")[0], 200)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_models_on_held_out_documents(spark):
    con = connect(SF_DIR.replace("0.001", "0.01"))
    for name, right in (("op1_quality_ranking", "predicted = quality"), ("op10_language_id", "lang_pred = lang")):
        found = QUERIES[name](spark, SF_DIR.replace("0.001", "0.01")).filter("held_out").toPandas()
        assert len(found) > 100
        share = con.sql(f"SELECT avg(({right})::INT) FROM found JOIN documents USING (doc_id) LEFT JOIN labels USING (doc_id)").fetchall()[0][0]
        assert share > 0.95, (name, share)


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls in every column, repeated rows, blank and very long texts, other columns, no rows."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = docs.limit(1).select(F.explode(F.array(
        *(F.struct(F.lit(i).cast("long").alias("doc_id"), F.lit(t).cast("string").alias("text")) for i, t in
          ((900_001, None), (900_002, ""), (None, None), (900_003, "12 .. 34"), (900_004, "the word and the word " * 20_000)))
    )).alias("r")).select("r.*", *(F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns[2:]))
    few = docs.orderBy("doc_id").limit(60)
    nameless = few.limit(3).withColumn("doc_id", F.lit(None).cast("long"))
    rows = few.unionByName(odd.select(docs.columns)).unionByName(few.limit(5)).unionByName(nameless)
    for c in ("ids", "n_tokens", "score", "print", "component", "mark", "_n"):
        rows = rows.withColumn(c, F.lit("mine"))
    others = {"labels": "doc_id", "benchmark": "item_id"}
    for name, frame in (("some", rows), ("none", rows.limit(0))):
        folder = str(tmp_path / name)
        frame.write.parquet(f"{folder}/documents.parquet")
        for table, key in others.items():
            given = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
            blank = given.limit(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in given.schema))
            given.unionByName(blank).unionByName(given.limit(2)).write.parquet(f"{folder}/{table}.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert out.columns[: len(rows.columns)] == rows.columns
        kept = [r.doc_id for r in out.select("doc_id").collect()]
        named = [i for i in kept if i is not None]
        assert len(named) == len(set(named)) and not {900_001, 900_002, 900_003} & set(named)
        assert bool(named) == (name == "some")
        # A copy without an id doesn't stay beside the one that has it.
        assert None not in kept


def test_stages_of_the_pipeline(spark):
    """Each stage against brute force, or its operator, on what the one before it kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF_DIR).cache()
        kept[name] = (before, docs)
        assert docs.columns[: len(columns)] == columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5

    texts = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    before, after = kept["MinHash near-dedup"]
    want = {i for i, (_, c) in groups(texts(before)).items() if i == c}
    assert {i for i, _ in texts(after)} == want
    before, after = kept["benchmark decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    want = {i for i, t in texts(before) if not contaminated(t, items)[1]}
    assert {i for i, _ in texts(after)} == want
    before, after = kept["SentencePiece encoding"]
    assert sorted(texts(after)) == sorted(texts(before))
    assert after.filter(F.size("ids") != F.col("n_tokens")).isEmpty()
    before, after = kept["quality classifier"]
    bad = {r[0] for r in duckdb.sql(f"SELECT doc_id FROM '{SF_DIR}/labels.parquet' WHERE quality = 0").fetchall()}
    known = {i for i, _ in texts(before)} & bad
    assert len(known & {i for i, _ in texts(after)}) <= 0.2 * len(known)
    run = corpus_pipeline.run(spark, SF_DIR)
    assert {i for i, _ in texts(run)} == {i for i, _ in texts(docs)}
