"""Archives made by hand, as other crawlers write them."""

import gzip

import pytest
from pyspark.sql import functions as F

from tokenwin.llm import crawl

HTML = b"<p>\xc3\xa9</p>\r\n\r\n<p>more</p>"


def warc(kind, ident, block, *more, eol=b"\r\n"):
    lines = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: <" + ident + b">", b"WARC-Date: 2020-01-02T03:04:05Z", *more]
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def response(n, body=HTML):
    http = b"HTTP/1.1 404 Not Found\r\nX-Long: " + b"y" * 50 * n + b"\r\ncontent-type: text/html\r\n\r\n" + body
    return warc(b"response", b"urn:uuid:r%d" % n, http, b"warc-target-uri: http://a/%d" % n, b"Content-Type: application/http; msgtype=response")


RECORDS = [
    warc(b"warcinfo", b"urn:uuid:i", b"software: other\r\n", b"Content-Type: application/warc-fields"),
    warc(b"request", b"urn:uuid:q", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", b"Content-Type: application/http; msgtype=request"),
    response(1), response(2, b"\x00" * 300_000), response(3, b""),
    warc(b"metadata", b"urn:uuid:m", b"fetchTimeMs: 5\r\n", b"WARC-Refers-To: <urn:uuid:r1>", b"X-Folded: a\r\n b"),
]


@pytest.fixture
def archive(tmp_path):
    folder = tmp_path / "crawl"
    folder.mkdir()
    (folder / "plain.warc").write_bytes(b"".join(RECORDS))
    (folder / "members.warc.gz").write_bytes(b"".join(map(gzip.compress, RECORDS)))
    (folder / "one.warc.gz").write_bytes(gzip.compress(b"".join(RECORDS)))
    (folder / "notes.txt").write_text("no archive")
    return f"file://{folder}"


def test_all_records_of_other_archives(spark, archive):
    rows = crawl.read_crawl(spark, archive).collect()
    for name in ("plain.warc", "members.warc.gz", "one.warc.gz"):
        own = [r for r in rows if r["file"].endswith(name)]
        assert [r["record_type"] for r in own] == ["warcinfo", "request", "response", "response", "response", "metadata"]
        assert [r["record_id"] for r in own][2:4] == ["urn:uuid:r1", "urn:uuid:r2"]
        assert own[2]["payload"] == HTML and own[2]["http_status"] == 404 and own[2]["http_type"] == "text/html"
        assert own[3]["payload"] == b"\x00" * 300_000 and own[4]["payload"] == b"" and own[2]["target_uri"] == "http://a/1"
        assert own[0]["payload"] == b"software: other\r\n" and own[5]["refers_to"] == "urn:uuid:r1" and own[1]["http_status"] is None
    assert len(rows) == 18


def test_unwanted_records_are_passed_over(spark, archive):
    scan = crawl.read_crawl(spark, archive).where((F.col("record_type") == "response") & F.col("target_uri").isin("http://a/1", "http://a/3"))
    assert sorted(r["record_id"] for r in scan.select("record_id", "payload").collect()) == ["urn:uuid:r1"] * 3 + ["urn:uuid:r3"] * 3
    reader = crawl.CrawlReader({"path": archive})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    left = list(reader.pushFilters([EqualTo(("record_type",), "metadata"), GreaterThan(("content_length",), 3)]))
    assert len(left) == 1 and reader.wanted == [("record_type", {"metadata"})]
    assert crawl.read_crawl(spark, archive, payload=False).where("payload is not null").count() == 0


def test_files_are_split_at_their_offsets(spark, archive):
    assert crawl.write_offsets(spark, archive) == 6 + 6 + 1
    for size in (1, 400, 100_000):
        parts = crawl.CrawlReader({"path": archive, "splitbytes": str(size)}).partitions()
        assert len(parts) > 3 or size > 400
        rows = crawl.read_crawl(spark, archive, split_bytes=size)
        assert rows.count() == 18 and rows.select("file", "record_id").distinct().count() == 18


def test_damaged_and_empty_archives(spark, tmp_path):
    assert crawl.read_crawl(spark, f"file://{tmp_path}").count() == 0
    (tmp_path / "cut.warc").write_bytes(RECORDS[2][:-40])
    with pytest.raises(Exception, match="ends within a record"):
        crawl.read_crawl(spark, f"file://{tmp_path}/cut.warc").collect()
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(RECORDS[3])[:-300])
    with pytest.raises(Exception, match="ends within"):
        crawl.read_crawl(spark, f"file://{tmp_path}/cut.warc.gz").collect()
    (tmp_path / "other.warc").write_bytes(b"HTTP/1.1 200\r\n\r\n")
    with pytest.raises(Exception, match="no start of a record"):
        crawl.read_crawl(spark, f"file://{tmp_path}/other.warc").collect()
