"""Archives and vectors."""

import base64
import gzip
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenwin.llm import vectors, warc
from tokenwin.llm.components import components


@pytest.fixture
def pages(spark):
    rows = [
        (3, "http://a/\r\nX: y", "<p>é</p>"), (1, "http://b/", "<p>é</p>"), (7, None, None), (5, "http://c/", ""),
        (9, "u", "z" * 300_000), (9, "u", "z" * 300_000), (None, "n", "<p>é</p>"), (None, "n", "alone"), (4, "", "\r\n\r\n"),
    ]
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, digest int")


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_archive_round_trip(spark, pages):
    rows = sorted(warc.archive_pages(spark, pages).collect(), key=str)
    assert len(rows) == 9
    found = {(r["page_id"], r["payload_digest"]): r for r in rows}
    for p in pages.collect():
        r = found[p["page_id"], sha(p["html"])]
        assert r["payload_bytes"] == len((p["html"] or "").encode())
        if r["record_type"] == "response":
            assert r["payload"].decode() == (p["html"] or "") and r["refers_to"] is None
        else:
            assert r["payload"] is None
    kinds = {k[0]: (r["record_type"], r["refers_to"]) for k, r in found.items() if k[0] is not None}
    assert kinds == {
        1: ("response", None), 3: ("revisit", 1), 5: ("response", None), 7: ("revisit", 5), 9: ("response", None), 4: ("response", None),
    }
    assert found[None, sha("<p>é</p>")]["refers_to"] == 1 and found[None, sha("alone")]["refers_to"] is None


def test_small_payloads_are_not_revisited(spark, pages, tmp_path):
    warc.register(spark)
    path = f"file://{tmp_path}/archive"
    warc.write_warc(pages, path, least_bytes=9)
    kinds = {r["page_id"]: r["record_type"] for r in warc.read_warc(spark, path).collect() if r["page_id"]}
    assert kinds[7] == "response" and kinds[3] == "revisit"
    members = [gzip.decompress(f.read_bytes()) for f in (tmp_path / "archive").iterdir() if f.name.endswith(".warc.gz")]
    assert sum(m.count(b"WARC/1.1\r\n") for m in members) == 9  # plain gzip reads them


def test_conditions_reach_the_scan(spark, pages, tmp_path):
    warc.register(spark)
    path = f"file://{tmp_path}/archive"
    warc.write_warc(pages, path)
    scan = warc.read_warc(spark, path).where((F.col("record_type") == "revisit") & F.col("page_id").isin(3, 4))
    assert [r["page_id"] for r in scan.collect()] == [3]
    reader = warc.WarcReader(path, payload=True)
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload",), b"")]))
    assert len(left) == 1
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert {r["record_type"] for r in rows} == {"revisit"}
    bare = warc.read_warc(spark, path, payload=False).collect()
    assert len(bare) == 9 and all(r["payload"] is None for r in bare)


def test_archive_of_no_pages(spark, pages):
    assert warc.archive_pages(spark, pages.limit(0)).count() == 0


def test_quantisation_bounds_every_product():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 33)) * 10.0 ** rng.integers(-5, 5, (200, 1))
    x[0] = 0
    x[0, 3] = 1
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    q, s, e = vectors.quantise(unit)
    approx = (q * s[:, None]) @ (q * s[:, None]).T
    assert (np.abs(unit @ unit.T - approx) <= e[:, None] + (1 + e)[:, None] * e[None, :] + 1e-9).all()


def make(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, id int, links string")


@pytest.mark.parametrize("tile", [1024, 16])
def test_links_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE", tile)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 16))
    x = np.repeat(base, 10, axis=0) + rng.normal(size=(120, 16)) * np.tile([0, 0, 0.05, 0.1, 0.2, 0.3, 0.3, 0.4, 0.5, 1], 12)[:, None]
    x = x.astype(np.float32).astype(np.float64)
    ids, labels = rng.permutation(120), np.arange(120) // 40
    found = vectors.near_vectors(make(spark, [(int(i), v.tolist(), int(c), 0, "x") for i, v, c in zip(ids, x, labels)]))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    link = (unit @ unit.T >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(link, False)
    comp = ids.copy()
    for _ in range(120):
        comp = np.minimum(comp, np.where(link, comp[None, :], 1000).min(axis=1))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found.collect()}
    assert got == {int(i): (int(n), int(c), bool(i == c)) for i, n, c in zip(ids, link.sum(axis=1), comp)}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 0), (6, [0.0, 0.0], 0),
        (7, [nan, 1.0], 0), (8, [inf, 1.0], 0), (9, [None, 1.0], 0), (10, [], 0), (11, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0),
        (12, [1.0, 0.0], 0), (12, [1.0, 0.0], 0),
    ]
    found = vectors.near_vectors(make(spark, [(*r, 0, "x") for r in rows])).collect()
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in found)
    alone = [(i, 0, i, True) for i in range(3, 12)]
    assert got == [(0, 0, None, False), (1, 3, 1, True), (2, 3, 1, False), *alone, (12, 3, 1, False), (12, 3, 1, False)]
    assert vectors.near_vectors(make(spark, [])).count() == 0


def test_components_of_long_paths_and_stars(spark):
    rng = np.random.default_rng(2)
    path = rng.permutation(60) + 1000
    links = [(int(a), int(b)) for a, b in zip(path, path[1:])] + [(5, i) for i in range(6, 40)] + [(3, 5), (2, 2), (None, 1), (1, None)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(found[int(i)] == 1000 for i in path) and all(found[i] == 3 for i in range(5, 40)) and found[2] == 2
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
