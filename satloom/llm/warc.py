"""WARC archives, written from and read into a table of chunks.

No record is held whole by Python: a payload is cut into rows of record identifier and chunk number inside Spark, the writer
streams those into gzip members, and the reader streams members out again in chunks that carry the digest so far.

Records with equal payloads are written once: the one of the smallest page_id is a response, the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satloom.llm import common as C

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


@dataclass(frozen=True)
class Limits:
    """chunk: bytes of a payload in a row; archive: bytes after which a new archive is begun (one record may exceed it)."""

    chunk: int = 1 << 18
    archive: int = 64 << 20


CHUNKS = "record string, page_id long, record_type string, refers_to long, chunk_no int, last boolean, data binary, bytes_so_far long, digest_so_far string"


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder, and the path in it: any that pyarrow knows (file, hdfs, s3, gs)."""
    return fs.FileSystem.from_uri(uri if re.match(r"^[a-z0-9]+:", uri) else f"file://{uri}")


def labelled(pages: DataFrame) -> DataFrame:
    """Each row of ``pages`` as page_id, url, html (binary), rid, digest, record_type and refers_to.

    Equal digests are met as one row each, after partial aggregation; giving rows their type is a join that can be split. Of
    rows that share the smallest page_id the first read is the response; a null page_id ranks last. page_id must be of an integer type.
    """
    C.whole_number(pages, "page_id")
    rows = C.pick(pages, "page_id", "url", "html").select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.encode(C.whole("html"), "UTF-8").alias("html"),
    )
    rows = rows.withColumn("digest", F.unhex(F.sha1("html"))).withColumn("place", C.place(F.col("page_id"), F.col("rid"), 1))
    firsts = rows.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.min("place").alias("first"))
    firsts = C.stored(firsts, f"{C.shared_dir(pages.sparkSession)}/firsts")
    own = F.col("place") == F.col("first")
    return rows.join(firsts, "digest").select(
        "rid", "page_id", "url", "html", "digest",
        F.when(own, "response").otherwise("revisit").alias("record_type"),
        F.when(~own, F.col("first_id")).alias("refers_to"),
        C.place_rid(F.col("first"), F.col("first_id"), 1).alias("refers_rid"),
    )


def chunk_rows(rows: DataFrame, limits: Limits) -> DataFrame:
    """A row for each chunk of each record, in order within it; a revisit has one without data."""
    size = F.octet_length("html")
    last = F.when(F.col("record_type") == "response", F.greatest(F.lit(0), F.ceil(size / limits.chunk).cast("int") - 1)).otherwise(0)
    cut = F.substring(F.col("html"), F.col("chunk_no") * limits.chunk + 1, F.lit(limits.chunk))
    rows = rows.withColumn("last", last.cast("int")).withColumn("size", size.cast("long"))
    rows = rows.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("last"))))
    return rows.select(
        "rid", "page_id", "url", "digest", "record_type", "refers_to", "refers_rid", "size", "chunk_no", (F.col("chunk_no") == F.col("last")).alias("last"),
        F.when(F.col("record_type") == "response", cut).otherwise(F.lit(b"")).alias("data"),
    )


def record_id(rid: int) -> str:
    return f"<urn:satloom:record:{rid}>"


def header(row: dict) -> bytes:
    url = re.sub(r"[^!-~]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), row["url"] or "") or f"urn:satloom:page:{row['page_id']}"
    response = row["record_type"] == "response"
    lines = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {record_id(row['rid'])}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{base32(row['digest'])}",
        f"X-Payload-Length: {row['size']}",
    ]
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    if not response:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(row['refers_rid'])}"]
        if row["refers_to"] is not None:
            lines.append(f"X-Refers-To-Page-Id: {row['refers_to']}")
    lines.append(f"Content-Length: {len(HTTP) + (row['size'] if response else 0)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + HTTP


class Archive:
    """One archive file, a gzip member for each record. It counts once ``closed`` gives its name; what a lost task left does not."""

    def __init__(self, folder: str, name: str) -> None:
        self.files, self.path = opened(f"{folder}/{name}")
        self.out = self.files.open_output_stream(self.path, compression=None)
        self.name, self.size, self.member = name, 0, None

    def write(self, data: bytes) -> None:
        if self.member is None:
            self.member = zlib.compressobj(6, zlib.DEFLATED, 31)
        self._put(self.member.compress(data))

    def end_record(self) -> None:
        self.write(b"\r\n\r\n")
        self._put(self.member.flush())
        self.member = None

    def _put(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.size += len(data)

    def closed(self) -> str:
        self.out.close()
        return self.name


def _writer(folder: str, limits: Limits):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        done: list[str] = []
        archive, digest = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
                if row["chunk_no"] == 0:
                    if archive is not None and archive.size >= limits.archive:
                        done.append(archive.closed())
                        archive = None
                    # A name of its own for each attempt: two attempts of one task never write one file.
                    archive = archive or Archive(folder, f"part-{uuid.uuid4().hex}.warc.gz")
                    archive.write(header(row))
                    digest = hashlib.sha1()
                archive.write(row["data"])
                digest.update(row["data"])
                if row["last"]:
                    if row["record_type"] == "response" and digest.digest() != row["digest"]:
                        raise ValueError(f"the chunks of record {row['rid']} are not in order")
                    archive.end_record()
        if archive is not None:
            done.append(archive.closed())
        yield pa.RecordBatch.from_pydict({"archive": pa.array(done, pa.string())})

    return write


def write_archives(pages: DataFrame, folder: str, limits: Limits = Limits()) -> DataFrame:
    """Writes a WARC record for each row of ``pages`` to archives in ``folder`` and gives their names, as a stored table.

    Null htmls count as empty, and empty payloads are records like any others. The names of archives whose task ended
    well are kept beside them, so that leftovers of lost executors are never read.
    """
    files, path = opened(folder)
    files.create_dir(path, recursive=True)
    names = chunk_rows(labelled(pages), limits).mapInArrow(_writer(folder, limits), "archive string")
    return C.stored(names, f"{folder}/names")


class Members:
    """Bytes of a file of gzip members, read through a window of bounded size."""

    def __init__(self, source, window: int = 1 << 18) -> None:
        self.source, self.window, self.raw, self.buffer = source, window, b"", bytearray()
        self.inflate = zlib.decompressobj(31)

    def fill(self) -> bool:
        while True:
            if self.inflate.eof:
                self.raw, self.inflate = self.inflate.unused_data or self.raw, zlib.decompressobj(31)
            if not self.raw:
                self.raw = self.source.read(self.window)
                if not self.raw:
                    return False
            got = self.inflate.decompress(self.raw, self.window)
            self.raw = b"" if self.inflate.eof else self.inflate.unconsumed_tail
            if got:
                self.buffer += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        """What stands before ``mark``, which is passed over; None at the end of the file."""
        seen = 0
        while (at := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark))
            if not self.fill():
                if self.buffer.strip():
                    raise ValueError("the archive ends within a record")
                return None
        found = bytes(self.buffer[:at])
        del self.buffer[: at + len(mark)]
        return found

    def some(self, most: int) -> bytes:
        if not self.buffer and not self.fill():
            raise ValueError("the archive ends within a record")
        found = bytes(self.buffer[:most])
        del self.buffer[: len(found)]
        return found

    def exactly(self, n: int) -> bytes:
        out = io.BytesIO()
        while out.tell() < n:
            out.write(self.some(n - out.tell()))
        return out.getvalue()


def records(source, chunk: int) -> Iterator[dict]:
    """The chunk rows of an archive's records. At most a chunk and a window are held."""
    stream = Members(source)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        length = int(fields["Content-Length"])
        http = stream.until(b"\r\n\r\n")
        left, chunk_no, size, digest = length - len(http) - 4, 0, 0, hashlib.sha1()
        own = {
            "record": fields["WARC-Record-ID"],
            "page_id": int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None,
            "record_type": fields["WARC-Type"],
            "refers_to": int(fields["X-Refers-To-Page-Id"]) if "X-Refers-To-Page-Id" in fields else None,
        }
        while True:
            data = stream.exactly(min(chunk, left))
            left -= len(data)
            size += len(data)
            digest.update(data)
            so_far = (size, base32(digest.digest()))
            if left == 0 and own["record_type"] == "revisit":
                # The payload stands in the record referred to; its length and digest are given here too.
                so_far = (int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:"))
            elif left == 0 and f"sha1:{so_far[1]}" != fields["WARC-Payload-Digest"]:
                raise ValueError(f"the payload of {own['record']} has another digest than its header says")
            yield own | {"chunk_no": chunk_no, "last": left == 0, "data": data, "bytes_so_far": so_far[0], "digest_so_far": so_far[1]}
            chunk_no += 1
            if left == 0:
                break
        if stream.exactly(4) != b"\r\n\r\n":
            raise ValueError(f"{own['record']} is longer than its header says")


def _reader(folder: str, limits: Limits, keep_data: bool):
    kinds = {"record": pa.string(), "page_id": pa.int64(), "record_type": pa.string(), "refers_to": pa.int64(), "chunk_no": pa.int32(),
             "last": pa.bool_(), "data": pa.binary(), "bytes_so_far": pa.int64(), "digest_so_far": pa.string()}
    schema = pa.schema(list(kinds.items()))

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names in batches:
            for name in names.column("archive").to_pylist():
                files, path = opened(f"{folder}/{name}")
                with files.open_input_stream(path, compression=None) as source:
                    rows: list[dict] = []
                    held = 0
                    for row in records(source, limits.chunk):
                        if not keep_data:
                            row["data"] = None
                        rows.append(row)
                        held += len(row["data"] or b"") + 200
                        if held >= 4 * limits.chunk:
                            yield batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch(rows)

    return read


def read_archives(names: DataFrame, folder: str, limits: Limits = Limits(), keep_data: bool = True) -> DataFrame:
    """The chunk table (CHUNKS) of the archives named; each chunk has bytes and digest of its record's payload so far.

    Archives are dealt one to a task. The last chunk of a record has the whole payload's length and digest.
    """
    count = max(1, names.count())
    return names.repartition(count, "archive").mapInArrow(_reader(folder, limits, keep_data), CHUNKS)


def round_trip(pages: DataFrame, folder: str | None = None, limits: Limits = Limits()) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each page, as its record in the archives has them."""
    folder = folder or f"{C.shared_dir(pages.sparkSession)}/warc"
    chunks = read_archives(write_archives(pages, folder, limits), folder, limits, keep_data=False)
    return chunks.where("last").select(
        "page_id",
        F.col("bytes_so_far").alias("payload_bytes"),
        F.col("digest_so_far").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


#: Base32 is written out in groups of 20 bits, four letters each.
OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
 d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x, row_number() OVER (PARTITION BY sha1(h) ORDER BY page_id NULLS LAST) AS n, first_value(page_id) OVER (PARTITION BY sha1(h) ORDER BY page_id NULLS LAST) AS f FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
 lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(((CAST('0x' || substr(x, 1 + 5 * CAST(i AS INT), 5) AS BIGINT) >> b) & 31) AS INT), 1)), '')), '') AS payload_digest,
 CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN n > 1 THEN f END AS refers_to FROM d
"""
