"""Reading tables, folds of ids, and sums of vectors over all partitions."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenwin.llm.spans import releasing
from tokenwin.sources.spread import spread

_CHUNK = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def fold(doc_id: Column | str, folds: int) -> Column:
    """Unsigned crc32 of the id as text, modulo ``folds``; a NULL id counts as empty text."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def fresh(columns: list[str], label: str) -> str:
    """A column name that is not among ``columns``."""
    name = f"_{label}"
    while name.lower() in {c.lower() for c in columns}:
        name += uuid.uuid4().hex[:4]
    return name


def sum_vectors(
    df: DataFrame, add: Callable[[Iterator[pa.RecordBatch], np.ndarray], None], size: int
) -> np.ndarray:
    """Sum over all partitions the int64 vector of fixed length that ``add`` fills from the batches.

    A partition sends its chunks of 4,096 cells that are not zero; each chunk is summed by its own
    group. Only the sum, whose length is fixed, comes to the driver.
    """
    chunks = -(-size // _CHUNK)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(chunks * _CHUNK, np.int64)
        add(batches, own)
        parts = own.reshape(chunks, _CHUNK)
        full = np.flatnonzero(parts.any(axis=1))
        for at in range(0, len(full), 64):
            yield _packed(full[at : at + 64], parts[full[at : at + 64]])

    def total(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in tables:
            for c, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = _unpacked(v.as_py())
                sums[c] = sums[c] + part if c in sums else part
        if sums:
            yield _packed(np.array(list(sums)), np.array(list(sums.values())))

    schema = "chunk int, cells binary"
    # As many tasks as there are chunks to share out, so that a task holds a bounded number of sums.
    parts = df.mapInArrow(releasing(partial), schema).repartition(max(1, min(16, chunks // 64)), "chunk")
    out = np.zeros(chunks * _CHUNK, np.int64).reshape(chunks, _CHUNK)
    for batch in parts.mapInArrow(releasing(total), schema).toArrow().to_batches():
        for c, v in zip(batch.column(0).to_pylist(), batch.column(1)):
            out[c] = _unpacked(v.as_py())
    return out.ravel()[:size]


def _packed(chunk: np.ndarray, cells: np.ndarray) -> pa.RecordBatch:
    """Cells in the smallest integer type that holds them; the length tells which."""
    out = []
    for row in cells:
        kind = next(t for t in (np.uint8, np.uint16, np.int32, np.int64) if row.min() >= np.iinfo(t).min and row.max() <= np.iinfo(t).max)
        out.append(row.astype(kind).tobytes())
    return pa.RecordBatch.from_arrays([pa.array(chunk, pa.int32()), pa.array(out, pa.binary())], ["chunk", "cells"])


def _unpacked(cells: bytes) -> np.ndarray:
    kind = {1: np.uint8, 2: np.uint16, 4: np.int32, 8: np.int64}[len(cells) // _CHUNK]
    return np.frombuffer(cells, kind).astype(np.int64)
