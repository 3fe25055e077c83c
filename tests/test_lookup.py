import math
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from tokenwin import shared
from tokenwin.operators.lookup import fits_broadcast, hot_keys, lookup, salted_join
from tokenwin.shared import release_tables, write_shared


def rows(spark):
    """Key 0 holds a third of the rows, key 1 a tenth, the rest is spread; some keys are unknown."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, 1).otherwise(F.col("id") % 5000)
    return spark.range(20000).select(F.col("id").alias("row"), key.alias("key"))


def table(spark):
    return spark.range(4000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"))


def test_salted_equals_broadcast(spark):
    for how in ("left", "inner"):
        small = lookup(rows(spark), table(spark), "key", ["row"], how)
        salted = lookup(rows(spark), table(spark), "key", ["row"], how, max_bytes=0)
        assert small.columns == salted.columns
        assert sorted(map(str, small.collect())) == sorted(map(str, salted.collect()))


def test_hot_rows_are_split(spark):
    hot = {r["key"]: r["_pieces"] for r in hot_keys(rows(spark), ["key"], 30).collect()}
    counts = Counter(r["key"] for r in rows(spark).collect())
    assert set(hot) == {0, 1}
    assert hot == {key: math.ceil(counts[key] / 20000 * 30) for key in hot}
    joined = salted_join(rows(spark), table(spark), ["key"], ["row"], "left", 30)
    assert joined.count() == 20000


def test_several_values_per_key(spark):
    double = table(spark).union(table(spark).withColumn("value", F.col("value") + 1))
    small = lookup(rows(spark), double, "key", ["row"])
    salted = lookup(rows(spark), double, "key", ["row"], max_bytes=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, salted.collect()))


def test_size_check(spark):
    assert fits_broadcast(spark.range(10), 8, 80)
    assert not fits_broadcast(spark.range(11), 8, 80)


def test_rows_without_key_are_spread(spark):
    key = F.when(F.col("id") % 2 == 0, F.col("id") % 5000)
    half = spark.range(20000).select(F.col("id").alias("row"), key.alias("key"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = salted_join(half, table(spark), ["key"], ["row"], "left", 8)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 20000 and len(sizes) == 8 and max(sizes) <= 2 * 20000 / 8


def test_measured_bytes_decide(spark):
    wide = write_shared(spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("word")), "wide")
    assert not fits_broadcast(wide, 64, 5000) and fits_broadcast(wide, 64, 20000)


def test_written_tables_are_released(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    kept = list(shared._written)
    shared._written.clear()
    try:
        write_shared(spark.range(3), "released")
        assert list(folder.glob("tokenwin/released-*"))
        release_tables(spark)
        assert not list(folder.glob("tokenwin/released-*"))
    finally:
        shared._written.extend(kept)
