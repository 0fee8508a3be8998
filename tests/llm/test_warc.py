"""Archives written, read back and assembled."""

from __future__ import annotations

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.session import scratch_dir

PAGES = "page_id long, url string, html string"
ODD = "WARC/1.1\r\n\r\n<p>\r\n\r\nnot the end</p>\r\n"


def written(spark, rows, **options):
    out = scratch_dir(spark, "warc")
    warc.write_archives(spark.createDataFrame(rows, PAGES).withColumn("payload", F.lit(1)), out, **options)
    return out


def test_round_trip(spark):
    rows = [(1, "http://a.example/x?y#z", "<p>é</p>"), (2, "https://b.example", ODD), (3, None, None), (7, "http://a\nb", "<p>é</p>")]
    rows += [(8, "http://c/", ""), (5, "http://a.example/", "<p>é</p>")]
    out = written(spark, rows)
    records = warc.read_archives(spark, out)
    assert records.count() == 3 * len(rows)
    got = {r.metadata.fields["page-id"]: r for r in warc.transactions(records).collect()}
    assert set(got) == {str(r[0]) for r in rows}
    for page, url, html in rows:
        row, payload = got[str(page)], (html or "").encode()
        full = row.capture.type == "response"
        assert full == (page in (7, 2, 8))
        if full:
            assert bytes(row.capture.payload) == payload
        assert row.capture.declared_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert row.capture.http_head.startswith("HTTP/1.1 200 OK")
        assert row.request.http_head.startswith("GET ") or url is None
        assert row.capture.target_uri == (url and url.replace("\n", " "))
    assert got["1"].capture.refers_to == got["7"].capture.record_id
    assert got["3"].capture.refers_to == got["8"].capture.record_id


def test_small_payloads_are_written_in_full(spark):
    out = written(spark, [(1, "http://a/", "same"), (2, "http://a/", "same")], least=5)
    kinds = warc.read_archives(spark, out).groupBy("type").count().collect()
    assert {r.type: r["count"] for r in kinds} == {"response": 2, "request": 2, "metadata": 2}


def test_repeated_rows_and_missing_ids(spark):
    rows = [(4, "http://a/", "same")] * 3 + [(None, "http://a/", "same"), (None, "http://a/", "other")]
    out = written(spark, rows)
    found = warc.transactions(warc.read_archives(spark, out)).collect()
    assert len(found) == 5 and all(r.request and r.metadata for r in found)
    assert sorted(r.capture.type for r in found) == ["response"] * 2 + ["revisit"] * 3
    assert sorted(r.metadata.fields.get("page-id", "-") for r in found) == ["-", "-", "4", "4", "4"]


def test_no_pages(spark):
    out = scratch_dir(spark, "warc")
    warc.write_archives(spark.createDataFrame([], PAGES), out)
    assert warc.transactions(warc.read_archives(spark, out)).count() == 0


def record(kind, name, block=b"", **more):
    headers = {"WARC-Type": kind, "WARC-Record-ID": name, "Content-Length": str(len(block)), **more}
    lines = [b"WARC/1.0", *(f"{k.replace('_', '-')}: {v}".encode() for k, v in headers.items()), b"", b""]
    return b"\r\n".join(lines) + block + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    """One gzip member per record, links in either direction, lost and unknown records."""
    http = {"Content-Type": "application/http;msgtype=response"}
    parts = [
        record("warcinfo", "<i>", b"software: x\r\n"),
        record("response", "<1>", b"HTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n", WARC_Concurrent_To="<1q>", **http),
        record("request", "<1q>", b"GET / HTTP/1.1\r\n\r\n"),
        record("metadata", "<1m>", b"k: v\r\n", WARC_Concurrent_To="<1>"),
        record("request", "<2q>", b"GET / HTTP/1.1\r\n\r\n", WARC_Concurrent_To="<lost>"),
        record("resource", "<3>", b"data"),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    (tmp_path / "b.warc").write_bytes(record("response", "<4>", b"", **http))
    rows = {r.capture_id: r for r in warc.transactions(warc.read_archives(spark, str(tmp_path))).collect()}
    assert set(rows) == {"<1>", "<lost>", "<3>", "<4>"}
    assert (rows["<1>"].request.record_id, rows["<1>"].metadata.record_id) == ("<1q>", "<1m>")
    assert bytes(rows["<1>"].capture.payload) == b"body\r\n\r\n"
    assert rows["<lost>"].capture is None and rows["<lost>"].request.record_id == "<2q>"
    assert bytes(rows["<3>"].capture.payload) == b"data" and rows["<3>"].request is None
    assert rows["<4>"].capture.payload_bytes == 0


@pytest.mark.parametrize("damage", [b"junk", record("response", "<1>", b"0123456789")[:-9]])
def test_damaged_archive_fails(damage):
    with pytest.raises(ValueError):
        list(warc.records(record("response", "<0>", b"x") + damage))
