from __future__ import annotations

import re
import uuid

import pytest
from pyspark.sql import functions as F

from tests.telemetry import disordered, frame
from tidemark.plans import catalog
from tidemark.plans.inputs import Inputs
from tidemark.operators.lateness import annotate_lateness, windows_changelog, windows_final
from tidemark.schema import WindowSpec, result_schema
from tidemark.sinks import lake, serving

SPEC = WindowSpec(10_000, 2_000, 40_000)
DAY_MS = 24 * 3_600_000
COLUMNS = ["sat_id", "window_start_ms", "revision", "sample_count", "snr_db_max"]


@pytest.fixture(scope="module")
def tagged(spark):
    return annotate_lateness(frame(spark, disordered(150, 9)), SPEC)


@pytest.fixture(scope="module")
def log(tagged):
    return windows_changelog(tagged, spec=SPEC).cache()


@pytest.fixture(scope="module")
def final(tagged):
    return windows_final(tagged, spec=SPEC).cache()


def table(spark, where, buckets=3):
    name = f"serving_{uuid.uuid4().hex}"
    serving.ensure(spark, name, result_schema(), str(where), buckets=buckets)
    return name


def same(a, b):
    a, b = a.select(*COLUMNS), b.select(*COLUMNS)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def files(where):
    return {str(p): p.stat().st_mtime_ns for p in where.rglob("part-*")}


def spread(rows):
    """The windows of one key three days later."""
    moved = F.when(F.col("sat_id") == "S1", F.col("window_start_ms") + 3 * DAY_MS)
    return rows.withColumn("window_start_ms", F.coalesce(moved, "window_start_ms"))


@pytest.mark.parametrize("hash_rows", [serving.HASH_ROWS, 0])
def test_upsert_keeps_the_highest_revision_in_any_order(
    spark, tmp_path, log, final, monkeypatch, hash_rows
):
    monkeypatch.setattr(serving, "HASH_ROWS", hash_rows)
    name = table(spark, tmp_path / "t")
    first = log.where("revision = 0")
    assert serving.upsert(first, name) == first.count()
    assert same(spark.table(name), first)
    for batch in (log, first, log.unionByName(log)):
        serving.upsert(batch, name)
        assert same(spark.table(name), final)
    assert serving.upsert(log.where("false"), name) == 0


def test_only_changed_days_are_written_and_a_day_has_a_file_per_bucket(spark, tmp_path, final):
    where = tmp_path / "t"
    name = table(spark, where, buckets=2)
    rows = spread(final)
    serving.upsert(rows, name)
    before = files(where)
    serving.upsert(rows, name)
    assert files(where) == before
    one = rows.where("sat_id = 'S1'").limit(1).withColumn("revision", F.lit(99))
    serving.upsert(one, name)
    after = files(where)
    days = {re.search(f"{lake.DAY}=(\\d+)", f)[1] for f, _ in set(after.items()) ^ set(before.items())}
    assert days == {str(one.select(lake.day_of(F.col("window_start_ms"))).first()[0])}
    assert all(len(list(d.glob("part-*"))) <= 2 for d in where.glob(f"{lake.DAY}=*"))
    assert spark.table(name).count() == rows.count()
    assert spark.table(name).where("revision = 99").count() == 1


def scans(plan):
    """Per scan of the table, the lines above it in its branch of an executed plan."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "FileScan parquet" in line and "Bucketed: true" in line:
            depth, above = len(line) - len(line.lstrip(" :+-*()0123456789")), []
            for earlier in reversed(lines[:i]):
                d = len(earlier) - len(earlier.lstrip(" :+-*()0123456789"))
                if d < depth:
                    depth = d
                    above.append(earlier)
            yield above


def test_stored_rows_are_neither_exchanged_nor_sorted(spark, tmp_path, log, final):
    name, keys = table(spark, tmp_path / "t"), list(serving.NATURAL_KEY)
    serving.upsert(final, name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = spark.table(name)
        batch = serving._dealt(log.where("revision = 0"), 3, keys)
        batch = batch.withColumn(lake.DAY, lake.day_of(F.col("window_start_ms")))
        for df in (
            serving._folded(stored, batch.select(*stored.columns), keys, "shuffle_hash"),
            serving.lookup(log, name),
        ):
            plan = df._jdf.queryExecution().executedPlan().toString()
            found = list(scans(plan))
            assert found, plan
            for above in found:
                assert any("ShuffledHashJoin" in line for line in above), plan
                assert not any("Exchange" in line or "Sort " in line for line in above), plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_reads_the_wanted_days_only(spark, tmp_path, final):
    name = table(spark, tmp_path / "t")
    rows = spread(final)
    serving.upsert(rows, name)
    keys = rows.where("sat_id = 'S1'").select("sat_id", "window_start_ms").limit(2)
    wanted = keys.unionByName(keys).unionByName(
        spark.createDataFrame([("none", 0), (None, 0), ("S1", None)], "sat_id string, window_start_ms bigint")
    )
    found = serving.lookup(wanted, name)
    assert same(found, rows.join(keys, ["sat_id", "window_start_ms"], "left_semi"))
    assert serving.lookup(wanted.where("false"), name).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert lake.DAY in re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]


def test_files_are_found_again_by_a_new_catalog_entry(spark, tmp_path, final):
    name = table(spark, tmp_path / "t")
    serving.upsert(spread(final), name)
    spark.sql(f"DROP TABLE {name}")
    again = table(spark, tmp_path / "t")
    assert same(spark.table(again), spread(final))
    with pytest.raises(ValueError, match="bucketed as"):
        serving.ensure(spark, again, result_schema(), str(tmp_path / "t"), buckets=5)


def test_a_null_key_is_refused_and_other_columns_may_be_more(spark, tmp_path, final):
    name = table(spark, tmp_path / "t")
    serving.upsert(final.withColumn("_held", F.lit(1)).withColumn("extra", F.lit(2)), name)
    assert same(spark.table(name), final)
    bad = final.withColumn("sat_id", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="null in required column sat_id"):
        serving.upsert(bad, name)
    assert same(spark.table(name), final)


def test_buckets_follow_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "SERVING_BUCKET_ROWS", 2)
    inputs = Inputs(spark, str(tmp_path))
    for rows, buckets in ((0, 2), (3, 2), (7, 4)):
        name = catalog._serving_table(inputs, (), rows)
        assert serving._layout(spark, name)[1] == buckets
