"""Dense row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenwin.operators.lookup import lookup
from tokenwin.shared import write_shared

# monotonically_increasing_id keeps the row's place in its partition in the lower 33 bits.
_PLACE_BITS = (1 << 33) - 1


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number rows 0, 1, 2, ... by ``order``, whose values must be unique.

    The range-sorted rows are written with their partition and place, which fixes both. Only
    the row count of each partition is then summed up in one task.
    """
    placed = write_shared(
        df.orderBy(*order).select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(_PLACE_BITS).alias("_place"),
        ),
        "numbered",
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    starts = sizes.select(
        "_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_start")
    )
    # One row per sort partition, so the broadcast is bounded by the number of tasks.
    return placed.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.col("_place")).alias(name)
    )


def number_rows_within(df: DataFrame, by: str, order: list[str], name: str) -> DataFrame:
    """Number the rows of each ``by`` value from 0; a single value may hold most of the rows."""
    numbered = number_rows(df, [by, *order], "_row")
    starts = write_shared(numbered.groupBy(by).agg(F.min("_row").alias("_first")), "starts")
    return lookup(numbered, starts, by, spread=["_row"]).select(
        *df.columns, (F.col("_row") - F.col("_first")).alias(name)
    )
