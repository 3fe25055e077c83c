"""Near-duplicate embeddings: exact links by cosine through products of int8 tiles.

Vectors of one label are dealt into tiles, and every pair of tiles of a label is one task's work. A
tile holds each unit vector a as 8-bit integers q and a scale s with the error e = |a - s q|, so for any two
|a.b - (s q).(s' q')| <= e + (1 + e) e'. Only pairs whose product may reach the threshold within that bound are worked
out again from the vectors in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenwin.llm.components import components
from tokenwin.operators.lookup import lookup
from tokenwin.shared import write_shared

THRESHOLD = 0.93
TILE = 1024
_CHUNK = 1 << 16
_TILE_ROW = "label int, dim int, tile int, tiles int, ids binary, copies binary, quantised binary, scales binary, errors binary, full binary"


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """8-bit integers, scale and error norm (rounded up) of each unit vector."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.sqrt(((unit - q * scale[:, None]) ** 2).sum(axis=1))
    return q, scale, error * (1 + 1e-9) + 1e-12


def _pack(rows: pa.Table) -> pa.Table:
    full = rows.column("v").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1).astype(np.float64)
    q, scale, error = quantise(full / np.sqrt((full**2).sum(axis=1))[:, None])
    first = {n: rows.column(n).slice(0, 1) for n in ("label", "dim", "tile", "tiles")}
    values = [rows.column("id").to_numpy(), rows.column("copies").to_numpy(), q, scale, error, full]
    names = ["ids", "copies", "quantised", "scales", "errors", "full"]
    return pa.table(first | {n: pa.array([v.tobytes()], pa.binary()) for n, v in zip(names, values)})


def _tile(row: dict) -> dict:
    n = len(row["ids"]) // 8
    kinds = {"ids": np.int64, "copies": np.int64, "quantised": np.int8, "scales": np.float64, "errors": np.float64, "full": np.float64}
    out = {k: np.frombuffer(row[k], kind) for k, kind in kinds.items()}
    return out | {"quantised": out["quantised"].reshape(n, -1), "full": out["full"].reshape(n, -1)}


def linked_pairs(a: dict, b: dict, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all pairs of two tiles with a cosine of at least ``threshold``; i < j within one."""
    # Sums of products of 8-bit integers are exact in float32 up to 2^24.
    kind = np.float32 if a["quantised"].shape[1] <= 1000 else np.float64
    product = (a["quantised"].astype(kind) @ b["quantised"].astype(kind).T).astype(np.float64)
    product *= a["scales"][:, None] * b["scales"][None, :]
    product += a["errors"][:, None] + (1 + a["errors"])[:, None] * b["errors"][None, :] + 1e-9
    possible = product >= threshold
    if same:
        possible = np.triu(possible, 1)
    i, j = np.nonzero(possible)
    norms = [np.sqrt((t["full"] ** 2).sum(axis=1)) for t in (a, b)]
    keep = np.zeros(len(i), np.bool_)
    for at in range(0, len(i), _CHUNK):
        x, y = i[at : at + _CHUNK], j[at : at + _CHUNK]
        cosine = np.einsum("ij,ij->i", a["full"][x], b["full"][y]) / (norms[0][x] * norms[1][y])
        keep[at : at + _CHUNK] = cosine >= threshold
    return i[keep], j[keep]


def _roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest place that each place is linked with, through any number of links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(group: pa.Table, threshold: float) -> pa.Table:
    """``(id, links, root)`` of each vector with a link: partners' copies, and a linked id to join it to."""
    rows = group.to_pylist()
    same = rows[0]["low"] == rows[0]["high"]
    if len(rows) < 2 and not same:  # the other tile got no vector
        return pa.table({n: pa.array([], pa.int64()) for n in ("id", "links", "root")})
    a, b = _tile(rows[0]), _tile(rows[-1])
    i, j = linked_pairs(a, b, same, threshold)
    n = len(a["ids"])
    ids = a["ids"] if same else np.concatenate([a["ids"], b["ids"]])
    copies = a["copies"] if same else np.concatenate([a["copies"], b["copies"]])
    j = j if same else j + n
    links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
    root = ids[_roots(i, j, len(ids))]
    some = np.flatnonzero(links)
    return pa.table({"id": ids[some], "links": links[some].astype(np.int64), "root": root[some]})


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``vectors(vec_id, embedding, label)``.

    Only vectors of one label and length are compared. A vector that is NULL, empty or zero, has a NULL or
    non-finite component or no label links with nothing; so does a row without id, whose component
    is NULL and which is not kept. Equal vectors are compared once and each counts as a link to the others;
    rows that repeat an id are vectors of their own. An empty table gives no rows.

    A label may hold nearly all rows: a task has one pair of tiles, found by its numbers. Links leave it as
    sums and as at most one line for each vector to the smallest place it leads to, never as all pairs.
    """
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = finite & F.exists(v, lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    hashes = [F.when(usable, F.xxhash64(F.lit(seed), v)).alias(f"h{seed}") for seed in (1, 2)]
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"), v.alias("v"), *hashes)
    key = ["label", "h1", "h2"]
    classes = rows.where("h1 is not null").groupBy(*key).agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.min_by("v", "vec_id").alias("v")
    )
    classes = write_shared(classes.withColumn("dim", F.size("v")), "classes")
    sizes = write_shared(classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")), "sizes")
    dealt = lookup(classes, sizes, ["label", "dim"], spread=["id"])
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("id"), "tiles").cast("int"))
    packed = dealt.groupBy("label", "dim", "tile").applyInArrow(_pack, _TILE_ROW)
    tiles = write_shared(packed, "tiles").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    meeting = tiles.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
    found = meeting.groupBy("label", "dim", "low", "high").applyInArrow(
        lambda group: _compare(group, threshold), "id bigint, links bigint, root bigint"
    )
    found = write_shared(found, "found")
    joined = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    linked = classes.select(*key, "id", "copies").join(links, "id", "left").join(joined, "id", "left")
    linked = linked.select(
        *key, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "id").alias("component")
    )
    out = lookup(rows.select("vec_id", *key), write_shared(linked, "linked"), key, spread=["vec_id"])
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
