"""Tables kept in the shared folder of the cluster.

A table that several jobs read, or whose row numbers must not change when a task is
repeated, is written once as Parquet below ``spark.checkpoint.dir``. Unlike a cached
DataFrame it survives the loss of executors, and its size is known to the optimizer.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_written: list[str] = []
_named: list[str] = []
_row_counts: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()
_byte_counts: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()
_arrays: WeakKeyDictionary[DataFrame, DataFrame] = WeakKeyDictionary()
_maps: WeakKeyDictionary[DataFrame, tuple[DataFrame, Callable]] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, else one in the warehouse, which executors share as well."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/tokenwin/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def _value_bytes(field: T.StructField) -> Column:
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        return F.greatest(F.size(column), F.lit(0)) * 16 + 16
    return F.lit(16 if isinstance(kind, T.StructType) else 8)


def write_shared(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once, counting its rows and bytes, and return a DataFrame that reads it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    seen = Observation()
    bytes_ = F.sum(sum((_value_bytes(f) for f in df.schema.fields), F.lit(16)).cast("bigint"))
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), bytes_.alias("bytes"))
    counted.write.partitionBy(*(partition_by or [])).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _row_counts[table] = seen.get["rows"]
    _byte_counts[table] = seen.get["bytes"] or 0
    return table


def write_bucketed(df: DataFrame, label: str, folders: list[str], buckets: int, by: str) -> DataFrame:
    """Write ``df`` once in folders and in buckets by an integer column; grouping by it reads a bucket a task.

    The table is known to the session's catalog under a fresh name until ``release_tables``.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    name = f"tokenwin_{label}_{uuid.uuid4().hex}"
    df.write.partitionBy(*folders).bucketBy(buckets, by).option("path", path).saveAsTable(name, format="parquet")
    _named.append(name)
    return spark.table(name)


def row_count(df: DataFrame) -> int | None:
    """Rows of a table that ``write_shared`` returned; None for any other."""
    return _row_counts.get(df)


def remember_count(df: DataFrame, rows: int) -> None:
    _row_counts[df] = rows


def same_rows(df: DataFrame, source: DataFrame) -> DataFrame:
    """``df``, which has as many rows as ``source`` or fewer, with the count that is known of ``source``."""
    if source in _row_counts:
        _row_counts[df] = _row_counts[source]
    return df


def measured_rows(df: DataFrame, column: str) -> int:
    """The rows of ``df`` as remembered, else counted over one column and then remembered."""
    if df not in _row_counts:
        _row_counts[df] = df.select(column).count()
    return _row_counts[df]


def byte_count(df: DataFrame) -> int | None:
    """Bytes of the values of a table that ``write_shared`` returned; None for any other."""
    return _byte_counts.get(df)


def remember_arrays(tokens: DataFrame, arrays: DataFrame) -> None:
    """``arrays(seq_id, _a)`` are what ``tokens`` were made of, one array a sequence."""
    _arrays[tokens] = arrays


def arrays_of(tokens: DataFrame) -> DataFrame | None:
    return _arrays.get(tokens)


def map_batches(
    df: DataFrame, columns: list[str], run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """``mapInArrow`` over some columns; after another one it runs in the same Python worker.

    Rows then do not travel between two workers, of which each would hold its own copy of what is broadcast.
    """
    source, before = _maps.get(df, (None, None))
    if source is None:
        source, both = df.select(*columns), run
    else:

        def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return run(before(batches))

    found = source.mapInArrow(both, schema)
    _maps[found] = source, both
    return found


def release_tables(spark: SparkSession) -> None:
    """Delete the tables that this process has written with ``write_shared``."""
    while _named:
        spark.sql(f"DROP TABLE IF EXISTS {_named.pop()}")
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship_package() -> None:
    """Pickle the functions of this package by value, so that workers need no copy of it.

    Not needed where the cluster has it installed or ``--py-files`` names it.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
