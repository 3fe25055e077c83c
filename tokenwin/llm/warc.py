"""WARC archives: a writer that revisits repeated payloads, and a Python data source that reads them.

An archive is a folder of files of one gzip member a record, and of ``_manifest``, which names the
files of the tasks that were committed; what a lost or repeated task left is not in it. Each member
states its length in the extra field ``sl`` of its gzip header. A file is one partition of a scan. The
scan inflates the headers of a record first: conditions on the record type and on other header
columns decide from them, and the rest of a record that is not wanted is passed over as it is.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

from tokenwin.operators.lookup import lookup
from tokenwin.shared import new_path, write_shared

SCHEMA = """page_id bigint, target_uri string, record_type string, payload_bytes bigint, payload_digest string,
refers_to bigint, payload binary"""
# Columns taken from the record's headers; conditions on them are tested before the payload is read.
_HEADERS = ("page_id", "target_uri", "record_type", "payload_bytes", "payload_digest", "refers_to")
_ID = "urn:page:"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_BATCH_BYTES = 8 << 20
_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("target_uri", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ]
)
# Fixed start of a gzip member with an extra field; then the field: its name, size, and two lengths.
_GZIP = bytes([0x1F, 0x8B, 8, 4, 0, 0, 0, 0, 0, 255])
_MEMBER, _TAIL = "<10sH2sHII", "<II"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _field(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in value)


def record(page_id: int | None, uri: str | None, refers_to: int | None, payload: bytes) -> bytes:
    """One record as a gzip member; a revisit keeps the HTTP header but not the payload."""
    kind = "response" if refers_to is None else "revisit"
    block = _HTTP + payload if refers_to is None else _HTTP
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"WARC-Record-ID: <{_ID}{page_id}>")
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_field(uri)}")
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <{_ID}{refers_to}>")
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    whole = head + block + b"\r\n\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, -15)
    packed = packer.compress(whole) + packer.flush()
    start = struct.pack(_MEMBER, _GZIP, 12, b"sl", 8, len(packed), len(whole))
    return start + packed + struct.pack(_TAIL, zlib.crc32(whole), len(whole))


def _parsed(head: bytes) -> dict:
    """The header columns of one record."""
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    number = lambda name: int(fields[name].strip("<>").removeprefix(_ID)) if name in fields else None
    return {
        "page_id": number("WARC-Record-ID"), "target_uri": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"], "payload_bytes": number("X-Payload-Length"),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "refers_to": number("WARC-Refers-To"),
    }


class ArchiveFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.wanted = path, payload, []

    def pushFilters(self, filters):
        """Take conditions on header columns; leave the others to Spark."""
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if isinstance(f, (EqualTo, In, IsNotNull)) and name in _HEADERS:
                values = None if isinstance(f, IsNotNull) else {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted.append((name, values))
            else:
                yield f

    def partitions(self) -> list[ArchiveFile]:
        system, root = _opened(self.path)
        with system.open_input_stream(f"{root}/_manifest") as f:
            names = f.read().decode().split()
        return [ArchiveFile(f"{self.path}/{name}") for name in names] or [ArchiveFile("")]

    def _keeps(self, row: dict) -> bool:
        return all(row[n] is not None and (v is None or row[n] in v) for n, v in self.wanted)

    def read(self, partition: ArchiveFile) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for row in self._records(partition.path) if partition.path else ():
            rows.append(row)
            held += 200 + len(row["payload"] or b"")
            if held >= _BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, _ARROW)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)

    def _records(self, path: str) -> Iterator[dict]:
        system, name = _opened(path)
        with system.open_input_stream(name, compression=None, buffer_size=1 << 20) as f:
            while start := f.read(struct.calcsize(_MEMBER)):
                _, _, _, _, packed, _ = struct.unpack(_MEMBER, start)
                member = f.read(packed)
                crc, _ = struct.unpack(_TAIL, f.read(struct.calcsize(_TAIL)))
                inflate, out = zlib.decompressobj(-15), b""
                while b"\r\n\r\n" not in out:
                    out += inflate.decompress(inflate.unconsumed_tail or member, 1024)
                row = _parsed(out[: out.index(b"\r\n\r\n")])
                if not self._keeps(row):
                    continue
                row["payload"] = None
                if self.payload and row["record_type"] == "response":
                    out += inflate.decompress(inflate.unconsumed_tail) + inflate.flush()
                    body = out.index(b"\r\n\r\n") + 4 + len(_HTTP)
                    row["payload"] = out[body : body + row["payload_bytes"]]
                    if zlib.crc32(out) != crc or base32_sha1(row["payload"]) != row["payload_digest"]:
                        raise ValueError(f"damaged record {row['page_id']} in {path}")
                yield row


class Written(WriterCommitMessage):
    def __init__(self, name: str):
        self.name = name


class WarcWriter(DataSourceArrowWriter):
    """Writes rows ``(page_id, target_uri, refers_to, payload)``, a file for each task."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = _opened(self.path)
        system.create_dir(root, recursive=True)
        message = Written(f"part-{uuid.uuid4().hex}.warc.gz")
        with system.open_output_stream(f"{root}/{message.name}", compression=None) as f:
            for batch in iterator:
                columns = [batch.column(n) for n in ("page_id", "target_uri", "refers_to", "payload")]
                for row in zip(*columns):
                    f.write(record(*(v.as_py() for v in row)))
        return message

    def commit(self, messages: list) -> None:
        system, root = _opened(self.path)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/_manifest") as f:
            f.write("\n".join(m.name for m in messages if m is not None).encode())


class WarcSource(DataSource):
    """``spark.read.format("warc")``; option ``payload`` false leaves payloads NULL and unread."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Archive ``pages(page_id, url, html)``.

    Of the records with one payload of at least ``least_bytes``, those with the smallest page_id are
    responses and the others revisit it; rows that repeat that id as well are all responses. A NULL
    html is an empty payload, a NULL url leaves its header out, and a NULL page_id sorts after all others: such a row
    is a revisit if any row with an id has its payload, else a response. Other columns are not read.

    Pages do not move: only digests that several pages share are looked up, by broadcast while few.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    shared = rows.where(F.length("payload") >= least_bytes).groupBy("digest")
    shared = shared.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    shared = write_shared(shared.select("digest", "first"), "payloads")
    found = lookup(rows, shared, "digest", spread=["page_id"])
    refers_to = F.when(F.length("payload") >= least_bytes, F.col("first"))
    refers_to = F.when(F.col("page_id").isNull() | (refers_to != F.col("page_id")), refers_to)
    out = found.select("page_id", "target_uri", refers_to.alias("refers_to"), "payload")
    out.write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages as an archive in the shared folder and read it back."""
    register(spark)
    path = new_path(spark, "warc")
    write_warc(pages, path)
    return read_warc(spark, path)
