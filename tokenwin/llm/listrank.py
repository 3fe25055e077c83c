"""Places in a linked list whose elements are spread over the cluster."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenwin.operators.lookup import lookup
from tokenwin.shared import write_shared

# Elements that one task links at a time, and heads that are few enough for a last round in one task.
CHUNK = 1 << 20
FEW = 1 << 16


def list_rank(arcs: DataFrame, near: list[str], few: int = FEW) -> DataFrame:
    """Replace ``next`` by ``pos``, the place of each element of one list, from 0.

    ``arcs`` has a unique ``id`` and the id of the ``next`` element, -1 at the end. Each task links the runs of successors it
    holds, and only their heads go on to the next round. The first round deals elements out by ranges of ``near``, which
    should keep successors together; a later one tosses a coin for each head and sends those with tails to the task of
    their successor, so that a quarter of the heads is expected to vanish, whatever the list looks like. When ``few`` are left, one task links
    them. Going back, an element adds its place in its run to that of the head.
    """
    extra = [c for c in arcs.columns if c not in ("id", "next")]
    levels = [_linked(arcs.withColumn("size", F.lit(1).cast("bigint")).repartitionByRange(*near), extra)]
    heads = _heads(levels[0])
    while heads.count() > few:
        # Another coin each round, the same when a task is repeated.
        coin = F.xxhash64("id", F.lit(len(levels))) % 2 == 0
        key = F.when(coin & (F.col("next") >= 0), F.col("next")).otherwise(F.col("id"))
        levels.append(_linked(heads.withColumn("_key", key).repartition("_key").drop("_key"), []))
        heads = _heads(levels[-1])
    levels.append(_linked(heads.repartition(1), []))
    placed = levels[-1].select(F.col("id").alias("head"), F.col("offset").alias("_start"))
    for level in reversed(levels[:-1]):
        placed = write_shared(placed, "places")
        found = lookup(level, placed, "head", spread=["id"], how="inner")
        pos = F.col("_start") + F.col("offset")
        if level is levels[0]:
            return found.select("id", *extra, pos.alias("pos"))
        placed = found.select(F.col("id").alias("head"), pos.alias("_start"))


def _heads(level: DataFrame) -> DataFrame:
    return level.where("id = head").select("id", "next", "size")


def _linked(elements: DataFrame, extra: list[str]) -> DataFrame:
    """``(id, head, offset, next, size)``: the run each element is in; heads have the run's successor and size."""
    schema = elements.select("id", *extra).schema.add("head", "long").add("offset", "long").add("next", "long").add("size", "long")
    names = schema.names

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches):
            ids, follows, size = (table.column(c).to_numpy() for c in ("id", "next", "size"))
            order = np.argsort(ids, kind="stable")
            at = np.minimum(np.searchsorted(ids, follows, sorter=order), len(ids) - 1)
            after = np.where(ids[order[at]] == follows, order[at], -1)
            inner = np.flatnonzero(after >= 0)
            jump, offset = np.arange(len(ids)), np.zeros(len(ids), np.int64)
            jump[after[inner]] = inner
            offset[after[inner]] = size[inner]
            while True:
                further = jump[jump]
                if (further == jump).all():
                    break
                offset += offset[jump]
                jump = further
            tails = np.flatnonzero(after < 0)
            goes_on, run = follows.copy(), size.copy()
            goes_on[jump[tails]], run[jump[tails]] = follows[tails], offset[tails] + size[tails]
            columns = [table.column(c).combine_chunks() for c in ("id", *extra)]
            columns += [pa.array(x) for x in (ids[jump], offset, goes_on, run)]
            yield from pa.table(columns, names).to_batches()

    chosen = elements.select("id", *extra, "next", "size")
    return write_shared(chosen.mapInArrow(link, schema), "linked")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= CHUNK:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)
