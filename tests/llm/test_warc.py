import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from satloom.llm import warc as W

PAGES = "page_id long, url string, html string"
ROWS = [
    (5, "http://a/", "<p>same</p>"),
    (3, "http://b/ é\n", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (None, "http://n/", "<p>same</p>"),
    (7, "http://e/", ""),
    (8, "http://e/", None),
    (1, "http://long/", "é" * 500_000 + "\r\n\r\nWARC/1.1\r\n"),
    (2, "http://twice/", "x\r\n\r\ny"),
    (2, "http://twice/", "x\r\n\r\ny"),
    (None, "http://only/", "no id"),
]


def brute(rows):
    payloads = [(p, (h or "").encode()) for p, _, h in rows]
    out = []
    for i, (p, data) in enumerate(payloads):
        first = min((q is None, q or 0, j) for j, (q, d) in enumerate(payloads) if d == data)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        own = first[2] == i
        out.append((p, len(data), digest, "response" if own else "revisit", None if own else payloads[first[2]][0]))
    return sorted(out, key=str)


def test_round_trip_of_odd_rows(spark, tmp_path):
    spark.createDataFrame(ROWS, PAGES).withColumn("digest", F.lit(1)).coalesce(1).write.parquet(f"{tmp_path}/pages")
    pages = spark.read.parquet(f"{tmp_path}/pages")
    for n, limits in enumerate((W.Limits(), W.Limits(chunk=1000, archive=2000))):
        folder = f"file://{tmp_path}/w{n}"
        assert sorted(map(tuple, W.round_trip(pages, folder, limits).collect()), key=str) == brute(ROWS)
    # The chunks put together are the payloads, and digests grow with them.
    names = spark.read.parquet(f"{folder}/names")
    chunks = W.read_archives(names, folder, limits).where("page_id = 1").orderBy("chunk_no").collect()
    assert [c["chunk_no"] for c in chunks] == list(range(1001)) and sum(c["last"] for c in chunks) == 1
    data = b""
    for c in chunks:
        data += c["data"]
        assert c["bytes_so_far"] == len(data)
    assert data == ROWS[6][2].encode()
    assert chunks[4]["digest_so_far"] == base64.b32encode(hashlib.sha1(data[:5000]).digest()).decode()
    assert names.count() > 1


def test_archives_are_plain_warc_in_gzip_members(spark, tmp_path):
    spark.createDataFrame(ROWS, PAGES).coalesce(1).write.parquet(f"{tmp_path}/pages")
    W.write_archives(spark.read.parquet(f"{tmp_path}/pages"), f"file://{tmp_path}/w")
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("*.gz"))
    assert raw.count(b"WARC-Record-ID") == len(ROWS) and raw.endswith(b"\r\n\r\n")


def test_broken_archives_are_told():
    row = {"page_id": 1, "url": "u", "digest": hashlib.sha1(b"abc").digest(), "record_type": "response", "refers_to": None, "refers_rid": 0, "rid": 0, "size": 3}
    good = W.header(row) + b"abc\r\n\r\n"
    assert list(W.records(io.BytesIO(gzip.compress(good)), 2))[-1]["bytes_so_far"] == 3
    for bad in (good[:-6], good.replace(b"abc", b"abd"), good.replace(b"abc\r", b"abcd")):
        with pytest.raises(ValueError):
            list(W.records(io.BytesIO(gzip.compress(bad)), 2))


def test_no_pages(spark, tmp_path):
    spark.createDataFrame([], PAGES).write.parquet(f"{tmp_path}/pages")
    assert W.round_trip(spark.read.parquet(f"{tmp_path}/pages")).count() == 0


def test_query_on_all_pages(spark):
    at = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{at}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, W.op2(spark, at).collect()), key=str) == brute(rows)
