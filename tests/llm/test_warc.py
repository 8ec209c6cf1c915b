"""The archive against plain Python: who is a response, exact records, and damage that must not pass."""

from __future__ import annotations

import base64
import glob
import gzip
import hashlib
from collections import Counter

import awkward
import pytest
from pyspark.sql import functions as F

from tripweave.llm import warc
from tripweave.llm.common import shipped

SCHEMA = "page_id long, url string, html string, sha1 string, bytes int, copies long, first int, copy long, header int, payload long"
PAGE = "<html>é 日本 \r\n\r\nWARC/1.1\r\n</html>"


def pages(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, 2, None, 3, 4, 5) for row in rows], SCHEMA)


def awkward_rows():
    rows = [(i, f"http://a/{i}", (PAGE, "", None, "b", "long " * 300_000)[i % 5]) for i in range(40)]
    rows += [(3, "http://a/3", "b"), (3, "http://a/3", "b"), (None, "http://n", PAGE), (None, None, "only"), (None, None, "only")]
    return rows + [(90, None, "x"), (91, "http://a/\r\nX-Page-ID: 7", "x"), (2, "http://a/other", None)]


def by_hand(rows, least=0):
    """(page_id, bytes, digest, type, refers_to) of every row, as the module's docstring has it."""
    groups = {}
    for page, url, html in rows:
        groups.setdefault((html or "").encode(), []).append((page is None, page or 0, url is None, url or ""))
    out = []
    for payload, own in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        own.sort()
        for place, (nameless, page, *_) in enumerate(own):
            first = None if own[0][0] else own[0][1]
            revisit = place > 0 and len(payload) >= least
            told = ("revisit", first) if revisit else ("response", None)
            out.append((None if nameless else page, len(payload), digest, *told))
    return Counter(out)


@pytest.mark.parametrize("least", [0, 2, 10**9])
def test_records_by_hand(spark, tmp_path, least):
    shipped(spark)
    rows = awkward_rows()
    warc.store(pages(spark, rows), str(tmp_path), least=least)
    got = warc.read(spark, str(tmp_path), content=False)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(map(tuple, got.select(*columns).collect())) == by_hand(rows, least)


def test_each_payload_is_stored_once_and_pages_come_back(spark, tmp_path):
    shipped(spark)
    rows = awkward_rows()
    warc.store(pages(spark, rows), str(tmp_path))
    stored = spark.read.parquet(f"{tmp_path}/payloads")
    assert stored.count() == len({h or "" for _, _, h in rows})
    back = warc.read(spark, str(tmp_path)).select("page_id", "url", F.decode("payload", "utf-8")).collect()
    safe = [(p, u and u.replace("\r", "%0D").replace("\n", "%0A"), h or "") for p, u, h in rows]
    assert Counter(map(tuple, back)) == Counter(safe)


def test_files_are_warc(spark, tmp_path):
    shipped(spark)
    rows = awkward_rows()
    warc.store(pages(spark, rows), f"{tmp_path}/archive")
    warc.write_files(spark, f"{tmp_path}/archive", f"{tmp_path}/files")
    found, ids = Counter(), Counter()
    for name in glob.glob(f"{tmp_path}/files/part-*"):
        data = gzip.open(name).read()
        while data:  # a record is as long as its header says, and two line ends follow
            head, rest = data.split(b"\r\n\r\n", 1)
            fields = warc.parsed(head.decode())
            assert head.startswith(b"WARC/1.1\r\n")
            block, data = rest[: int(fields["Content-Length"])], rest[int(fields["Content-Length"]) :]
            assert data[:4] == b"\r\n\r\n"
            data = data[4:]
            http, payload = block.split(b"\r\n\r\n", 1)
            assert http.startswith(b"HTTP/1.1 200 OK")
            if fields["WARC-Type"] == "response":
                assert fields["WARC-Payload-Digest"] == f"sha1:{warc.sha1_base32(payload)}"
            else:
                assert payload == b"" and "WARC-Refers-To" in fields
            found[fields["WARC-Type"]] += 1
            ids[fields["WARC-Record-ID"]] += 1
            if "WARC-Refers-To" in fields:
                ids[fields["WARC-Refers-To"]] += 0
    payloads = len({h or "" for _, _, h in rows})
    assert found == {"response": payloads, "revisit": len(rows) - payloads}
    assert set(ids.values()) == {1}  # every record has a name of its own, and those referred to are there


def test_damaged_payload_is_an_error(spark, tmp_path):
    shipped(spark)
    warc.store(pages(spark, [(1, "u", "abc"), (2, "u", "abd")]), f"{tmp_path}/a")
    warc.store(pages(spark, [(1, "u", "abd"), (2, "u", "abc")]), f"{tmp_path}/b")
    one, two = (spark.read.parquet(f"{tmp_path}/{x}/payloads") for x in "ab")
    swapped = one.join(two.select(F.col("sha1").alias("s"), F.col("payload").alias("p")), F.col("sha1") != F.col("s"))
    swapped.select("sha256", "sha1", "bytes", F.col("p").alias("payload")).write.mode("overwrite").parquet(f"{tmp_path}/c/payloads")
    spark.read.parquet(f"{tmp_path}/a/records").write.parquet(f"{tmp_path}/c/records")
    with pytest.raises(Exception, match="another digest"):
        warc.read(spark, f"{tmp_path}/c").collect()


def test_empty_table(spark, tmp_path):
    shipped(spark)
    warc.store(pages(spark, []), str(tmp_path))
    assert warc.read(spark, str(tmp_path)).count() == 0
    assert awkward.by_row(warc.read(spark, str(tmp_path), content=False)) == []
