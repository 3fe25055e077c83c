"""Compare a Spark result with a DuckDB result: columns, rows and values."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_KINDS = {
    "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "int", "HUGEINT": "int",
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int",
    "FLOAT": "float", "DOUBLE": "float", "float": "float", "double": "float",
    "VARCHAR": "string", "string": "string", "BOOLEAN": "boolean", "boolean": "boolean",
}


def _normal(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def _order(row):
    return tuple((v is None, str(type(v)), v) for v in row)


def differences(spark_df: DataFrame, sql: str, sf_dir: str) -> list[str]:
    """Reasons why the results differ; none if they are equal."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    problems = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} instead of {sorted(names)}"]
    for name, kind in spark_df.dtypes:
        if _KINDS.get(kind, kind) != _KINDS.get(types[name], types[name]):
            problems.append(f"{name}: {kind} instead of {types[name]}")
    by_name = sorted(names)
    got = sorted((tuple(_normal(r[n]) for n in by_name) for r in spark_df.collect()), key=_order)
    at = [names.index(n) for n in by_name]
    want = sorted((tuple(_normal(r[i]) for i in at) for r in expected), key=_order)
    if len(got) != len(want):
        problems.append(f"{len(got)} rows instead of {len(want)}")
    different = [(g, w) for g, w in zip(got, want) if g != w]
    if different:
        problems.append(f"{len(different)} rows differ, first {different[0][0]} instead of {different[0][1]}")
    if not want:
        problems.append("no rows to compare")
    return problems
