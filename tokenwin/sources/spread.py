"""Even work over the cores where a table comes in too few pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Repartition a scan that has fewer splits than there are cores.

    Splitting and exploding a row costs far more than reading it, so one big Parquet row group
    would keep a single core busy. A large table has enough splits and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
