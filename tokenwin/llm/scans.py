"""Running sums over a whole sorted table, without one task that sees it all."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenwin.shared import write_shared

# Sums are kept modulo this, so that two of them add up within a long.
MODULUS = 1 << 62


def running_sums(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Add ``run_<value>``: the sum up to each row, itself included, within its ``keys`` in ``order``, modulo 2^62.

    Keys and values are longs without NULL, and keys and order together are unique. The table is range-sorted, so a
    key may span many tasks; each sums up its own rows, and the sum that a task's first key brings from the tasks before is
    added afterwards. One row a task comes to the driver for that.
    """
    names = df.columns
    schema = T.StructType(list(df.schema.fields))
    for v in values:
        schema = schema.add(f"run_{v}", "long")
    schema = schema.add("_lead", "boolean").add("_part", "integer").add("_place", "long")
    mask = np.uint64(MODULUS - 1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, lead = TaskContext.get().partitionId(), 0, True
        carried: list[np.uint64] = [np.uint64(0)] * len(values)
        open_key: tuple | None = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            own = [batch.column(k).to_numpy() for k in keys]
            changes = np.zeros(n, np.bool_)
            for column in own:
                changes[1:] |= column[1:] != column[:-1]
            key = tuple(int(c[0]) for c in own)
            changes[0] = open_key is not None and key != open_key
            starts = np.flatnonzero(changes)
            run = np.cumsum(changes)
            sums = []
            for j, v in enumerate(values):
                total = np.cumsum(batch.column(v).to_numpy().astype(np.uint64))
                # What the running total was before each key of the batch began.
                offset = np.concatenate([[np.uint64(0) - carried[j]], np.concatenate([[np.uint64(0)], total])[starts]])
                total = (total - offset[run]) & mask
                sums.append(pa.array(total.astype(np.int64)))
                carried[j] = total[-1]
            leads = (run == 0) & lead
            lead = lead and not len(starts)
            open_key = tuple(int(c[-1]) for c in own)
            fixed = [pa.array(leads), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(place, place + n))]
            place += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums, *fixed], schema.names)

    placed = write_shared(df.orderBy(*keys, *order).mapInArrow(scan, schema), "scanned")
    ends = [F.max_by(f"run_{v}", "_place").alias(f"run_{v}") for v in values]
    edges = [F.min_by(k, "_place").alias(f"low_{i}") for i, k in enumerate(keys)] + [F.max_by(k, "_place").alias(f"high_{i}") for i, k in enumerate(keys)]
    carries, key, sums = [], None, [0] * len(values)
    for row in sorted(placed.groupBy("_part").agg(*ends, *edges).collect(), key=lambda r: r["_part"]):
        low, high = (tuple(row[f"{side}_{i}"] for i in range(len(keys))) for side in ("low", "high"))
        same = low == key
        if same:
            carries.append((row["_part"], *sums))
        grows = same and low == high  # the key that came in goes on through the whole task
        sums = [((s if grows else 0) + row[f"run_{v}"]) % MODULUS for s, v in zip(sums, values)]
        key = high
    fields = ", ".join(f"_c{j} bigint" for j in range(len(values)))
    # One row a task at most.
    carried_in = F.broadcast(df.sparkSession.createDataFrame(carries, f"_part int, {fields}"))
    whole = placed.join(carried_in, "_part", "left")
    added = [
        F.when(F.col("_lead") & F.col(f"_c{j}").isNotNull(), (F.col(f"run_{v}") + F.col(f"_c{j}")).bitwiseAND(MODULUS - 1)).otherwise(F.col(f"run_{v}")).alias(f"run_{v}")
        for j, v in enumerate(values)
    ]
    return whole.select(*names, *added)
