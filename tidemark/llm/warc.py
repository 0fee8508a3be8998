"""WARC archives: writing captures, reading records back, assembling transactions.

A capture is three records: the response, or a revisit of an equal payload captured
elsewhere; its request; and metadata. The last two name the first in WARC-Concurrent-To.
Archives are written by Spark's text writer, whose line separator is the blank lines that
end a record, so they land in any store that Spark writes to, through its commit protocol.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import BATCH_BYTES, bounded_batches, by_bytes

VERSION = "WARC/1.1"
CRLF = "\r\n"
#: Payloads of fewer bytes are always written in full.
LEAST_REVISIT_BYTES = 0
#: Bytes of payload per archive file, by the mean payload, and records at most; a file is
#: read by one task. A file holds no more than what one task writes.
FILE_BYTES = 256 << 20
FILE_RECORDS = 6_000


def _base32(hex_digits: Column) -> Column:
    """RFC 4648 upper-case base32 of hexadecimal digits, ten at a time as eight."""
    digits, letters = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = [
        F.lpad(F.conv(F.substring(hex_digits, k, 10), 16, 32), 8, "0") for k in range(1, 41, 10)
    ]
    return F.translate(F.upper(F.concat(*parts)), digits, letters)


def _urn(kind: str, key: Column) -> Column:
    """A record id that depends on the capture alone, so a task run again writes the same."""
    h = F.sha2(F.concat_ws(":", F.lit(kind), key), 256)
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(headers: dict[str, Column], block: Column) -> Column:
    """The text of a record without the blank lines at its end; null headers are left out."""
    headers = headers | {"Content-Length": F.octet_length(block).cast("string")}
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in headers.items()]
    return F.concat(F.concat_ws(CRLF, F.lit(VERSION), *lines), F.lit(2 * CRLF), block)


def _one_line(value: Column) -> Column:
    """A header value can't hold line breaks."""
    return F.regexp_replace(value, "[\r\n]+", " ")


def captures(pages: DataFrame, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """``pages`` as captures: ``page_id, url, payload, sha1, key, response``.

    ``key`` tells captures apart, and ``response`` is the key of the capture whose payload
    this one repeats, or null. Of equal payloads of at least ``least`` bytes the one with
    the largest page id is the response. Only hashes are grouped by payload; payloads move
    once, dealt out by page id and payload together.
    """
    pages = pages.select(
        "page_id",
        F.coalesce(F.col("page_id").cast("string"), F.lit("none")).alias("page"),
        "url",
        F.coalesce("html", F.lit("")).alias("payload"),
    ).withColumn("print", F.sha2("payload", 256))
    # Rows that repeat a page id and payload are captures of their own, told apart by number.
    same = Window.partitionBy("page", "print").orderBy("url")
    rows = pages.withColumn("key", F.concat_ws("/", "page", "print", F.row_number().over(same)))
    narrow = pages.select("page_id", "page", "print", F.octet_length("payload").alias("n")).filter(F.col("n") >= least)
    last = narrow.groupBy("print").agg(F.max("page_id").alias("last"), F.count("*").alias("m")).filter("m > 1")
    last_page = F.coalesce(F.col("last").cast("string"), F.lit("none"))
    to = F.concat_ws("/", last_page, "print", F.lit("1"))
    repeated = narrow.select("page", "print").distinct().join(last, "print").select("page", "print", to.alias("to"))
    return rows.join(repeated, ["page", "print"], "left").select(
        "page_id",
        "url",
        "payload",
        F.sha1("payload").alias("sha1"),
        "key",
        F.when(F.col("to") != F.col("key"), F.col("to")).alias("response"),
    )


def write_archives(
    pages: DataFrame, out: str, least: int = LEAST_REVISIT_BYTES, date: str = "1970-01-01T00:00:00Z"
) -> None:
    """Write three records per row of ``pages(page_id, url, html)`` to gzipped archives.

    A null html is an empty payload, a null url leaves the target out, a null page id is
    left out of the metadata. An empty table writes no records.
    """
    mean = pages.agg(F.avg(F.octet_length("html"))).first()[0]
    per_file = max(1, min(FILE_RECORDS, int(3 * FILE_BYTES / (mean or 1.0))))
    rows = captures(pages, least)
    own = F.when(F.col("response").isNull(), _urn("response", F.col("key"))).otherwise(_urn("revisit", F.col("key")))
    url = _one_line(F.col("url"))
    common = {"WARC-Target-URI": url, "WARC-Date": F.lit(date)}
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(2 * CRLF),
    )
    is_response = F.col("response").isNull()
    main = _record(
        {
            "WARC-Type": F.when(is_response, "response").otherwise("revisit"),
            "WARC-Record-ID": own,
            **common,
            "WARC-Refers-To": F.when(~is_response, _urn("response", F.col("response"))),
            "WARC-Profile": F.when(~is_response, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            "WARC-Payload-Digest": F.concat(F.lit("sha1:"), _base32(F.col("sha1"))),
            "Content-Type": F.lit("application/http;msgtype=response"),
        },
        F.when(is_response, F.concat(head, "payload")).otherwise(head),
    )
    host = F.regexp_extract(url, "^[a-z]+://([^/?#]*)", 1)
    target = F.regexp_extract(url, "^[a-z]+://[^/?#]*([^#]*)", 1)
    asked = F.concat(F.lit("GET "), target, F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(2 * CRLF))
    request = _record(
        {
            "WARC-Type": F.lit("request"),
            "WARC-Record-ID": _urn("request", F.col("key")),
            **common,
            "WARC-Concurrent-To": own,
            "Content-Type": F.lit("application/http;msgtype=request"),
        },
        F.coalesce(asked, F.lit(2 * CRLF)),
    )
    metadata = _record(
        {
            "WARC-Type": F.lit("metadata"),
            "WARC-Record-ID": _urn("metadata", F.col("key")),
            **common,
            "WARC-Concurrent-To": own,
            "Content-Type": F.lit("application/warc-fields"),
        },
        F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit("")),
    )
    (
        rows.select(F.explode(F.array(main, request, metadata)).alias("value"))
        .write.option("lineSep", 2 * CRLF)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", per_file)
        .text(out)
    )


def records(data: bytes) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Headers, by lower-case name, and block of each record of an archive."""
    file = gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while line := file.readline():
        if not line.strip():
            continue  # blank lines end the record before
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should begin: {line[:60]!r}")
        headers: dict[str, list[str]] = {}
        while (line := file.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(headers["content-length"][0])
        block = file.read(size)
        if len(block) != size:
            raise ValueError("the archive ends within a record")
        yield headers, block


def _row(file: str, headers: dict[str, list[str]], block: bytes, payloads: bool) -> dict:
    one = lambda name: headers.get(name, [None])[0]
    kind, content = one("warc-type"), one("content-type") or ""
    head, payload, fields = None, block, None
    if content.startswith("application/http"):
        raw, _, payload = block.partition(b"\r\n\r\n")
        head = raw.decode("utf-8", "replace")
    elif content.startswith("application/warc-fields"):
        pairs = (x.partition(":") for x in block.decode("utf-8", "replace").splitlines())
        fields = [(k.strip(), v.strip()) for k, _, v in pairs if k.strip()]
        fields = list(dict(fields).items())
    return {
        "file": file,
        "record_id": one("warc-record-id"),
        "type": kind,
        "target_uri": one("warc-target-uri"),
        "concurrent_to": headers.get("warc-concurrent-to", []),
        "refers_to": one("warc-refers-to"),
        "declared_digest": (one("warc-payload-digest") or "").removeprefix("sha1:") or None,
        "payload_bytes": len(payload),
        "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode(),
        "http_head": head,
        "fields": fields,
        "payload": payload if payloads else None,
    }


RECORD = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("concurrent_to", T.ArrayType(T.StringType())),
        T.StructField("refers_to", T.StringType()),
        T.StructField("declared_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("http_head", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.BinaryType()),
    ]
)
_ARROW = pa.schema(
    [
        *((n, pa.string()) for n in ("file", "record_id", "type", "target_uri")),
        ("concurrent_to", pa.list_(pa.string())),
        ("refers_to", pa.string()),
        ("declared_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("http_head", pa.string()),
        ("fields", pa.map_(pa.string(), pa.string())),
        ("payload", pa.binary()),
    ]
)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``; see ``RECORD`` for the columns.

    Length and digest are those of the payload as read: of an HTTP message what follows its
    head, else the block. ``payloads=False`` leaves the bytes themselves out. A damaged
    archive fails the job. A file is held by one task, as Spark's readers hand it over.
    """
    bounded_batches(spark)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = (_row(name, headers, block, payloads) for headers, block in records(data))
                size = lambda r: 1_000 + len(r["payload"] or b"")
                for part in by_bytes(rows, BATCH_BYTES, size):
                    yield pa.RecordBatch.from_pylist(part, _ARROW)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(of, RECORD)


MAIN = ("response", "revisit", "resource")


def transactions(rows: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, capture, request, metadata``.

    Requests and metadata belong to the capture that they name in WARC-Concurrent-To, or
    that names them. All three are brought together in one exchange, as an outer join: what
    is missing is null, also the capture of a request whose own was lost. Of several records
    of a kind the one with the smallest id is taken. Other types of records are left out.
    """
    names = [c for c in rows.columns if c not in ("type", "concurrent_to")]
    whole = F.struct("type", *names).alias("record")
    main = rows.filter(F.col("type").isin(*MAIN))
    rest = rows.filter(F.col("type").isin("request", "metadata"))
    role = F.when(F.col("type").isin(*MAIN), "capture").otherwise(F.col("type")).alias("role")
    shared = [role, "record_id", whole]
    named = rest.select(F.explode("concurrent_to").alias("capture_id"), *shared)
    back = main.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("other"))
    back = back.join(rest.withColumnRenamed("record_id", "other"), "other").withColumn("record_id", F.col("other"))
    back = back.select("capture_id", *shared)
    every = main.select(F.col("record_id").alias("capture_id"), *shared).unionByName(named).unionByName(back)

    def first(kind: str) -> Column:
        chosen = F.col("role") == kind
        return F.min_by(F.when(chosen, F.col("record")), F.when(chosen, F.col("record_id"))).alias(kind)

    return every.groupBy("capture_id").agg(first("capture"), first("request"), first("metadata"))
