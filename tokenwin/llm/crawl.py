"""WARC records of any crawler, plain or gzipped, read by a Python data source.

``path`` is a file or a folder of ``.warc`` and ``.warc.gz`` files. A record ends where its own Content-Length says, whether
each record is a gzip member, a file is one member, or there is no compression. The header of a record is parsed first;
conditions on header columns decide from it, and the block of a record that is not wanted is passed over: by a seek in a plain
file, and inflated without being kept in a gzipped one. ``write_offsets`` writes where the records of a file start; a file that has
its offsets beside it is split into several partitions.

Header names are matched in any case. Ids are texts, as they stand between the angle brackets. A record without a type or length,
or a file that ends within a record, raises an error with the place. A folder without such files gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull

SCHEMA = """file string, offset bigint, record_id string, record_type string, target_uri string, date string, refers_to string,
content_type string, content_length bigint, http_status int, http_type string, payload binary"""
# Header columns and the names of their fields.
_FIELDS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date",
    "refers_to": "warc-refers-to", "content_type": "content-type", "content_length": "content-length",
}
_ARROW = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), *((n, pa.string()) for n in list(_FIELDS)[:-1]), ("content_length", pa.int64())]
    + [("http_status", pa.int32()), ("http_type", pa.string()), ("payload", pa.binary())]
)
_OFFSETS = ".offsets"
SPLIT_BYTES = 128 << 20
_CHUNK, _BATCH_BYTES, _HEAD_BYTES = 1 << 16, 8 << 20, 1 << 20


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class _Bytes:
    """The bytes of a file from ``start`` on, inflated if it is gzipped, of which few are held."""

    def __init__(self, path: str, start: int):
        system, name = _opened(path)
        self.file, self.zipped = system.open_input_file(name), name.endswith(".gz")
        self.file.seek(start)
        self.held, self.raw, self.at = bytearray(), b"", start  # at: place in the file of what raw and held begin with
        self.inflate, self.fresh = None, start  # fresh: where the member starts whose first byte is the next one, else None

    def _more(self) -> bool:
        if not self.zipped:
            new = self.file.read(_CHUNK)
            self.held += new
            return bool(new)
        while True:
            if not self.raw:
                self.raw = self.file.read(_CHUNK)
                if not self.raw:
                    if self.inflate is not None:
                        raise ValueError("the file ends within a gzip member")
                    return False
            if self.inflate is None:
                self.inflate = zlib.decompressobj(31)
                if not self.held:
                    self.fresh = self.at
            new = self.inflate.decompress(self.raw, _CHUNK)
            left = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            self.at += len(self.raw) - len(left)
            self.raw = left
            if self.inflate.eof:
                self.inflate = None
            if new:
                self.held += new
                return True

    def place(self) -> int:
        """Where the next byte is in the file, -1 if it is inside a gzip member; the end of the file has no next byte."""
        if not self.held:
            self._more()
        if not self.zipped:
            return self.file.tell() - len(self.held)
        return -1 if self.fresh is None else self.fresh

    def _drop(self, n: int) -> None:
        del self.held[:n]
        if n:
            self.fresh = None

    def until(self, mark: bytes) -> bytes | None:
        """What stands before ``mark``, which is taken as well; None at the end of the file."""
        while (at := self.held.find(mark)) < 0:
            if len(self.held) > _HEAD_BYTES or not self._more():
                if self.held.strip(b"\r\n"):
                    raise ValueError("no end of a record's header")
                return None
        out = bytes(self.held[:at])
        self._drop(at + len(mark))
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("the file ends within a record")
        out = bytes(self.held[:n])
        self._drop(n)
        return out

    def skip(self, n: int) -> None:
        if not self.zipped and n > len(self.held):
            end = self.file.tell() + n - len(self.held)
            if end > self.file.size():
                raise ValueError("the file ends within a record")
            self.file.seek(end)
            self.held.clear()
            return
        while n:
            if not self.held and not self._more():
                raise ValueError("the file ends within a record")
            part = min(n, len(self.held))
            self._drop(part)
            n -= part

    def skip_line_ends(self) -> None:
        while self.held or self._more():
            rest = self.held.lstrip(b"\r\n")
            self._drop(len(self.held) - len(rest))
            if rest:
                return


def _header(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"{lines[0][:40]!r} is no start of a record")
    fields: dict[str, str] = {}
    name = ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:  # a value goes on
            fields[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def _http(block: bytes) -> tuple[int | None, str | None, bytes]:
    """Status and type of an HTTP message, and what follows its header."""
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    status = lines[0].split(" ")[1:2]
    kind = next((v.strip() for n, _, v in (line.partition(":") for line in lines[1:]) if n.strip().lower() == "content-type"), None)
    return int(status[0]) if lines[0].startswith("HTTP/") and status and status[0].isdigit() else None, kind, body


class Range(InputPartition):
    def __init__(self, path: str, start: int, stop: int | None):
        self.path, self.start, self.stop = path, start, stop


class CrawlReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.payload = options["path"], options.get("payload", "true").lower() == "true"
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.wanted: list[tuple[str, set | None]] = []

    def pushFilters(self, filters):
        """Take conditions on header columns; leave the others to Spark."""
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if isinstance(f, (EqualTo, In, IsNotNull)) and name in _FIELDS:
                values = None if isinstance(f, IsNotNull) else {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted.append((name, values))
            else:
                yield f

    def partitions(self) -> list[Range]:
        system, root = _opened(self.path)
        info = system.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(root, recursive=True))
        names = {f.path for f in found}
        out = []
        for f in sorted((f for f in found if f.is_file and f.path.endswith((".warc", ".warc.gz"))), key=lambda f: f.path):
            cuts = [0]
            if f.size > self.split and f.path + _OFFSETS in names:
                with system.open_input_stream(f.path + _OFFSETS) as file:
                    for offset in map(int, file.read().split()):
                        if offset - cuts[-1] >= self.split:
                            cuts.append(offset)
            path = self.path if info.is_file else self.path.rstrip("/") + f.path[len(root.rstrip("/")) :]
            out += [Range(path, a, b) for a, b in zip(cuts, [*cuts[1:], None])]
        return out or [Range("", 0, None)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for row in self._records(partition) if partition.path else ():
            rows.append(row)
            held += 400 + len(row["payload"] or b"")
            if held >= _BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, _ARROW)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)

    def _records(self, part: Range) -> Iterator[dict]:
        data = _Bytes(part.path, part.start)
        offset = part.start
        try:
            while True:
                data.skip_line_ends()
                offset = data.place()
                if part.stop is not None and offset >= part.stop:
                    return
                head = data.until(b"\r\n\r\n")
                if head is None:
                    return
                fields = _header(head)
                row = {name: fields.get(field) for name, field in _FIELDS.items()}
                size = int(fields["content-length"])
                if row["record_type"] is None:
                    raise ValueError("a record without type")
                row |= {"file": part.path, "offset": offset, "content_length": size, "http_status": None, "http_type": None, "payload": None}
                for name in ("record_id", "refers_to"):
                    row[name] = row[name] and row[name].strip("<>")
                if all(row[n] is not None and (v is None or row[n] in v) for n, v in self.wanted):
                    if self.payload:
                        block = data.take(size)
                        row["payload"] = block
                        if (row["content_type"] or "").lower().startswith("application/http"):
                            row["http_status"], row["http_type"], row["payload"] = _http(block)
                    else:
                        data.skip(size)
                    yield row
                else:
                    data.skip(size)
        except (ValueError, KeyError, zlib.error) as e:
            raise ValueError(f"{part.path}, record at or after {offset}: {e}") from e


class CrawlSource(DataSource):
    """``spark.read.format("crawl")``; option ``payload`` false leaves payloads NULL, ``splitbytes`` is the least size of a range."""

    @classmethod
    def name(cls) -> str:
        return "crawl"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CrawlReader:
        return CrawlReader(dict(self.options))


def read_crawl(spark: SparkSession, path: str, payload: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CrawlSource)
    return spark.read.format("crawl").option("payload", str(payload).lower()).option("splitbytes", str(split_bytes)).load(path)


def write_offsets(spark: SparkSession, path: str) -> int:
    """Write beside each file where its records start, and return how many there are.

    Only places that a reader can start at count: all records of a plain file, and those at the start of a gzip member. A file's
    offsets are written by one task, some ten bytes a record.
    """

    def write(group: pa.Table) -> pa.Table:
        system, name = _opened(group.column("file")[0].as_py())
        offsets = sorted(o for o in group.column("offset").to_pylist() if o >= 0)
        with system.open_output_stream(name + _OFFSETS, compression=None) as file:
            file.write("\n".join(map(str, offsets)).encode())
        return pa.table({"n": pa.array([len(offsets)], pa.int64())})

    places = read_crawl(spark, path, payload=False).select("file", "offset")
    return sum(r["n"] for r in places.groupBy("file").applyInArrow(write, "n bigint").collect())
