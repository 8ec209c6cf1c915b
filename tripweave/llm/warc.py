"""A content-addressed archive of web pages that gives back WARC records.

Two tables make up an archive. ``payloads`` holds the bytes of every distinct payload once, under
its SHA-256 and SHA-1, compressed. ``records`` holds the exact headers of every record (the WARC
header with its blank line and the HTTP header with its own) and the digests of its payload.
Payloads are one only if length and both digests agree. Whoever reads a payload digests its bytes
again; bytes that do not give their name are an error and never a record. A join of the two tables
gives the original records.

Of equal payloads of at least ``least`` bytes the page with the smallest id (then the smallest
address) is the response, the others are revisits that refer to it; smaller payloads are responses
all. A null text is an empty payload. Pages without an id come after all others, and a revisit of
such a page refers to no id. Equal rows are captures of their own: one response, revisits else. An
empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm.common import pieces, settled, utf8

DATE = "2024-01-01T00:00:00Z"  # of records whose pages do not say when they were fetched
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
KEY = ["sha256", "sha1", "bytes"]
LEVEL = 9
CONTROL = re.compile(r"[\x00-\x1f\x7f]")
OUT_BYTES = 8 << 20  # payloads whose records leave a task together


class DamagedPayload(Exception):
    """Stored bytes that do not have the digests they are stored under."""


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _payloads(batch: pa.RecordBatch, at: int) -> Iterator[bytes]:
    data, bounds = utf8(batch.column(at))
    stored = memoryview(data)
    return (bytes(stored[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()))


def _one_line(url: str | None) -> str | None:
    """An address without control characters, which could end a header line: they are written as %0D."""
    return url and CONTROL.sub(lambda found: f"%{ord(found[0]):02X}", url)


def named(pages: DataFrame) -> DataFrame:
    """``page_id, url`` and the name of the payload (``sha256, sha1, bytes``), without the payload."""

    def run(batches):
        for batch in pieces(batches, 2):
            urls = pa.array(map(_one_line, batch.column(1).to_pylist()), pa.string())
            names = [(hashlib.sha256(p).hexdigest(), sha1_base32(p), len(p)) for p in _payloads(batch, 2)]
            columns = [pa.array(x, t) for x, t in zip(zip(*names), (pa.string(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), urls, *columns], ["page_id", "url", *KEY])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id long, url string, sha256 string, sha1 string, bytes long")


def distinct_payloads(pages: DataFrame) -> DataFrame:
    """``sha256, sha1, bytes, payload``: every payload once. Copies are dropped before the shuffle and after it."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in pieces(batches, 0):
            own = {}
            for payload in _payloads(batch, 0):
                key = (hashlib.sha256(payload).hexdigest(), sha1_base32(payload), len(payload))
                if key not in own:
                    own[key] = pack(payload)
            columns = [pa.array(x, t) for x, t in zip(zip(*own), (pa.string(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(own.values()), pa.binary())], [*KEY, "payload"])

    packed = pages.select("html").mapInArrow(run, "sha256 string, sha1 string, bytes long, payload binary")
    return packed.dropDuplicates(KEY)


def _record_id(page_id: str, url: str, copy: str | Column) -> Column:
    told = [F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in (page_id, "sha256", url)]
    return F.regexp_replace(
        F.md5(F.concat_ws("|", copy, *told)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>"
    )


def _line(name: str, value: Column) -> Column:
    """A header line, nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def headers(captures: DataFrame, date: str = DATE, least: int = 0) -> DataFrame:
    """``header, sha256, sha1, bytes``: a row for every capture of ``named``, with the header its record has."""
    counted = settled(captures.groupBy("page_id", "url", *KEY).agg(F.count("*").alias("copies")), "captures")
    order = F.struct(F.isnull("page_id").alias("nameless"), "page_id", F.isnull("url").alias("homeless"), "url")
    # written, so that the join has an exchange on either side and the engine can split a payload of many pages
    first = settled(counted.groupBy(*KEY).agg(F.min(order).alias("first")), "responses")
    rows = counted.join(first, KEY).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    rows = rows.withColumns({"first_id": F.col("first.page_id"), "first_url": F.col("first.url")})
    is_first = (F.col("copy") == 1) & F.expr("page_id <=> first_id AND url <=> first_url")
    revisits = (F.col("bytes") >= least) & ~is_first
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    length = F.octet_length(http) + F.when(revisits, 0).otherwise(F.col("bytes"))
    only_revisits = {
        "WARC-Profile": F.lit(REVISIT),
        "WARC-Refers-To": _record_id("first_id", "first_url", F.lit("1")),
        "WARC-Refers-To-Target-URI": F.col("first_url"),
        "X-Refers-To-Page-ID": F.col("first_id"),
    }
    lines = [
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisits, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id("page_id", "url", F.col("copy").cast("string"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        *[_line(name, F.when(revisits, value)) for name, value in only_revisits.items()],
        _line("X-Page-ID", F.col("page_id")),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", length),
        F.lit("\r\n"),
        http,
    ]
    return rows.select(F.concat(*lines).alias("header"), *KEY)


def store(pages: DataFrame, path: str, date: str = DATE, least: int = 0) -> None:
    """Write an archive of ``pages`` (``page_id, url, html``; further columns are left aside)."""
    headers(named(pages), date, least).write.option("compression", "zstd").parquet(f"{path}/records")
    distinct_payloads(pages).write.parquet(f"{path}/payloads")


def parsed(header: str) -> dict[str, str]:
    """The fields of a WARC header."""
    lines = header.split("\r\n\r\n", 1)[0].split("\r\n")
    return dict(line.split(": ", 1) for line in lines[1:])


def _unpacked(name: tuple[str, str, int], packed: bytes) -> bytes:
    """The payload, if its bytes have the name they are stored under."""
    payload = zstandard.ZstdDecompressor().decompress(packed, max_output_size=max(1, name[2]))
    if (hashlib.sha256(payload).hexdigest(), sha1_base32(payload), len(payload)) != name:
        raise DamagedPayload(f"bytes stored as {name} have another digest")
    return payload


READ = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "record binary, payload binary"
)
READ_NAMES = [field.split()[0] for field in READ.split(", ")]


def _rebuilt(header: str, payload: bytes) -> tuple:
    """What one record and its payload say, and the bytes of the record."""
    fields = parsed(header)
    record = header.encode() + (payload if fields["WARC-Type"] == "response" else b"")
    block = len(record) - record.index(b"\r\n\r\n") - 4
    digest = sha1_base32(payload)
    if block != int(fields["Content-Length"]) or fields["WARC-Payload-Digest"] != f"sha1:{digest}":
        raise DamagedPayload(f"record {fields['WARC-Record-ID']} does not fit its payload")
    page, referred = (int(fields[k]) if k in fields else None for k in ("X-Page-ID", "X-Refers-To-Page-ID"))
    return page, fields.get("WARC-Target-URI"), fields["WARC-Type"], referred, len(payload), digest, record, payload


def read(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """The records of an archive, each put together from its header and its payload and checked against both.

    ``page_id, url, record_type, refers_to, payload_bytes, payload_digest`` (of the whole payload, also
    for a revisit), and with ``content`` the exact bytes of the ``record`` and of the ``payload``.
    """
    records, payloads = (spark.read.parquet(f"{path}/{name}") for name in ("records", "payloads"))
    wanted = READ_NAMES if content else READ_NAMES[:-2]

    def run(batches):
        known, payload = None, b""  # a payload of many records is unpacked once
        for batch in batches:
            out, size = [], 0
            for row in range(batch.num_rows):
                header, *name, packed = (column[row].as_py() for column in batch.columns)
                if tuple(name) != known:
                    known, payload = tuple(name), _unpacked(tuple(name), packed)
                out.append(_rebuilt(header, payload)[: len(wanted)])
                size += len(payload)
                if size >= OUT_BYTES:
                    yield _batch(out, wanted)
                    out, size = [], 0
            yield _batch(out, wanted)

    joined = records.join(payloads, KEY).select("header", *KEY, "payload")
    return joined.mapInArrow(run, ", ".join(READ.split(", ")[: len(wanted)]))


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def write_files(spark: SparkSession, path: str, target: str, compression: str = "gzip") -> None:
    """The records of an archive as WARC files, every record followed by the two line ends the format asks for."""
    records = read(spark, path).select(F.col("record").cast("string").alias("value"))
    records.write.option("lineSep", "\r\n\r\n").option("compression", compression).text(target)
