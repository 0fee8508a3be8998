from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.telemetry import disordered, frame
from tidemark.operators.lateness import annotate_lateness, windows_changelog, windows_final
from tidemark.schema import WindowSpec, result_schema
from tidemark.sinks import changelog, lake

SPEC = WindowSpec(10_000, 2_000, 40_000)


@pytest.fixture(scope="module")
def log(spark):
    return windows_changelog(
        annotate_lateness(frame(spark, disordered(150, 9)), SPEC), spec=SPEC
    ).cache()


@pytest.fixture(scope="module")
def final(spark):
    return windows_final(
        annotate_lateness(frame(spark, disordered(150, 9)), SPEC), spec=SPEC
    ).cache()


def same(a, b):
    columns = ["sat_id", "window_start_ms", "revision", "sample_count", "snr_db_max"]
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_upsert_is_idempotent_and_ignores_older_batches(spark, tmp_path, log, final):
    path = str(tmp_path / "serving")
    first = log.where("revision = 0")
    assert lake.upsert(first, path, result_schema()) == first.count()
    for batch in (log, log, first):
        lake.upsert(batch, path, result_schema())
        assert same(lake.scan(spark, path, result_schema()), final)
    assert lake.upsert(log.where("false"), path, result_schema()) == 0


def test_upsert_leaves_keys_outside_the_batch_alone(spark, tmp_path, final):
    path = str(tmp_path / "serving")
    lake.upsert(final, path, result_schema())
    one = final.where("sat_id = 'S1'").limit(1).withColumn("revision", F.lit(99))
    lake.upsert(one, path, result_schema())
    assert lake.scan(spark, path, result_schema()).count() == final.count()
    assert lake.scan(spark, path, result_schema()).where("revision = 99").count() == 1


def test_drilldown_reads_one_partition(spark, tmp_path, final):
    path = str(tmp_path / "serving")
    lake.append(final, path)
    plan = (
        lake.scan(spark, path, result_schema()).where("sat_id = 'S1'")
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "PartitionFilters: [isnotnull(sat_id" in plan


def test_null_in_a_required_column_is_an_error(spark, final):
    bad = final.withColumn("anomaly_type", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="null in required column anomaly_type"):
        lake.enforce_schema(bad, result_schema()).collect()


def test_table_is_created_once(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    schema = T.StructType([*result_schema().fields[1:], result_schema().fields[0]])
    for _ in range(2):
        table = lake.ensure_table(spark, name, schema, location=str(tmp_path / "t"))
        assert table.columns == schema.names and table.count() == 0


def test_export_is_sorted_json(tmp_path, final):
    path = tmp_path / "export"
    lake.export_json(final, str(path))
    rows = [
        json.loads(line)
        for part in sorted(path.glob("part-*"))
        for line in part.read_text().splitlines()
    ]
    keys = [(r["sat_id"], r["window_start_ms"]) for r in rows]
    assert keys == sorted(keys) and len(keys) == final.count()


def test_changelog_batch_is_replaced_when_run_again(spark, tmp_path, log, final):
    path = str(tmp_path / "log")
    for batch_id, batch in ((0, log.where("revision = 0")), (1, log.where("revision > 0"))):
        changelog.write_batch(batch, path, "q", batch_id)
        changelog.write_batch(batch, path, "q", batch_id)
    stored = changelog.read_batches(spark, path)
    assert stored.count() == log.count()
    assert same(changelog.latest_view(stored), final)
    serving = str(tmp_path / "serving")
    changelog.refresh(stored.where("batch_id = 0"), serving, result_schema())
    changelog.refresh(stored, serving, result_schema(), after_batch_id=0)
    assert same(lake.scan(spark, serving, result_schema()), final)


def test_merge_statement_guards_the_revision():
    sql = lake.merge_statement("lake.windows", "batch", ["key", "revision"], keys=["key", "day"])
    assert "t.`key` = s.`key` AND t.`day` = s.`day`" in sql and "sat_id" not in sql
    assert "PARTITION BY `key`, `day` ORDER BY `revision` DESC" in sql
    assert "WHEN MATCHED AND s.`revision` > t.`revision`" in sql


def test_upsert_writes_only_days_with_newer_rows(spark, tmp_path, log, final):
    path = str(tmp_path / "serving")
    day = 24 * 3_600_000
    moved = F.when(F.col("sat_id") == "S1", F.col("window_start_ms") + 3 * day)
    rows = final.withColumn("window_start_ms", F.coalesce(moved, "window_start_ms"))
    fields = [T.StructField(c, T.IntegerType()) for c in (lake.DAY, lake.BUCKET)]
    schema = T.StructType([*result_schema().fields, *fields])

    def refresh(batch):
        lake.upsert(lake.laid_out(batch, 2), path, schema, partition_by=[lake.DAY, lake.BUCKET])
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "serving").rglob("part-*")}

    first = refresh(rows)
    assert refresh(rows) == first
    newer = rows.where("sat_id = 'S1'").withColumn("revision", F.col("revision") + 1)
    second = refresh(newer)
    changed = set(first.items()) ^ set(second.items())
    assert changed and not any(f"{lake.DAY}={d}/" in name for name, _ in changed for d in (-1, 0, 1))
