"""Joins of many rows to a table with one row per key."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tokenwin.shared import byte_count, remember_count, row_count, same_rows, write_shared

# A table is broadcast only when its measured bytes, or its rows times a stated width, stay below this.
BROADCAST_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, row_bytes: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Compare the bytes measured at writing, and rows of a stated width; at most one row more than allowed is counted.

    A count that stays below the limit is remembered for the same DataFrame.
    """
    if (byte_count(df) or 0) > max_bytes:
        return False
    max_rows = max_bytes // row_bytes
    rows = row_count(df)
    if rows is None:
        rows = df.limit(max_rows + 1).count()
        if rows <= max_rows:
            remember_count(df, rows)
    return rows <= max_rows


def hot_keys(rows: DataFrame, on: list[str], partitions: int) -> DataFrame:
    """Keys with more rows than an average partition, and the pieces each is split into.

    The rows are counted in one pass, and keys with several of them are written. There are fewer hot keys
    than partitions, so they may always be broadcast.
    """
    total = Observation()
    counts = rows.groupBy(*on).agg(F.count("*").alias("_n")).observe(total, F.sum("_n").alias("rows"))
    counts = write_shared(counts.where("_n > 1"), "keys")
    share = F.col("_n") * partitions / F.lit(total.get["rows"] or 1)
    return counts.where(share > 1).select(*on, F.ceil(share).cast("int").alias("_pieces"))


def salted_join(
    rows: DataFrame, table: DataFrame, on: list[str], spread: list[str], how: str, partitions: int
) -> DataFrame:
    """Shuffle join in which the rows of a hot key are split over several tasks.

    ``spread`` names columns of ``rows`` that tell the rows of one key apart. The pieces of all
    hot keys together are fewer than twice ``partitions``, so ``table`` hardly grows. Rows with a NULL
    key find nothing and go to any task.
    """
    hot = F.broadcast(hot_keys(rows, on, partitions))
    scattered = F.xxhash64(*spread)
    no_key = functools.reduce(operator.or_, [F.col(c).isNull() for c in on])
    pieces = F.coalesce("_pieces", F.lit(1))
    piece = F.pmod(scattered, F.when(no_key, partitions).otherwise(pieces)).cast("int")
    left = rows.join(hot, on, "left").withColumn("_piece", piece).drop("_pieces")
    right = table.join(hot, on, "left").withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return left.join(right.drop("_pieces"), [*on, "_piece"], how).drop("_piece")


def lookup(
    rows: DataFrame,
    table: DataFrame,
    on: str | list[str],
    spread: list[str],
    how: str = "left",
    row_bytes: int = 64,
    max_bytes: int = BROADCAST_BYTES,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join each row to its key in ``table``: broadcast if the table is small, else salted.

    ``counted`` may name a table with as many rows that is cheaper to count. A known number of ``rows`` goes
    on to the result, which has no more.
    """
    on = [on] if isinstance(on, str) else on
    if fits_broadcast(table if counted is None else counted, row_bytes, max_bytes):
        return same_rows(rows.join(F.broadcast(table), on, how), rows)
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return same_rows(salted_join(rows, table, on, spread, how, partitions), rows)
