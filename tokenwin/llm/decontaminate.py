"""Benchmark decontamination: short test items inside documents of any length, in DataFrame operations only.

Items are partitioned by size, and each size has a sketch of its own: the shingles with the smallest hashes, a
MinHash sample of the item. A document is asked how many of them it contains, which estimates the
item's containment whatever the length of the document. Where the estimate reaches half the
threshold, all shingles of the item are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenwin.operators.lookup import fits_broadcast, lookup
from tokenwin.shared import write_shared

WORDS = 5
CONTAINMENT = 0.8
# Sketch sizes: of items up to so many shingles, so many are drawn; of small items all.
SKETCHES = ((16, 16), (64, 20), (256, 28))
LARGEST_SKETCH = 40
_SEPARATORS = r"[^\p{L}\p{N}]+"


def words(text: Column | str) -> Column:
    """Runs of letters and digits in lower case; none for NULL."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATORS), lambda w: w != "")


def word_runs(df: DataFrame, key: str) -> DataFrame:
    """``(key, shingle)``: hashes of all different runs of five words; none for shorter texts.

    One column a step, as an expression inside a lambda would be worked out for each element. The
    outer form keeps the optimizer from a test of the array, which would be pushed below and do just that.
    """
    hashed = df.select(key, F.transform(words("text"), lambda w: F.xxhash64(w)).alias("w"))
    starts = F.slice("w", 1, F.greatest(F.size("w") - (WORDS - 1), F.lit(0)))
    run = F.transform(starts, lambda _, i: F.xxhash64(*[F.get("w", i + k) for k in range(WORDS)]))
    rows = hashed.select(key, F.explode_outer(F.array_distinct(run)).alias("shingle"))
    return rows.where(F.col("shingle").isNotNull())


def item_shingles(benchmark: DataFrame) -> DataFrame:
    """``(item_id, shingle, size)`` with the number of different shingles of the item.

    Rows that repeat an item id make up one item; items without id or of fewer than five words have none.
    """
    rows = word_runs(benchmark.where(F.col("item_id").isNotNull()), "item_id")
    pairs = rows.distinct()
    sizes = pairs.groupBy("item_id").agg(F.count("*").alias("size"))
    return write_shared(pairs.join(sizes, "item_id"), "items")


def sketches(items: DataFrame) -> DataFrame:
    """``(item_id, shingle, drawn)``: the sketch of each item and its size."""
    most = F.lit(LARGEST_SKETCH)
    for size, drawn in reversed(SKETCHES):
        most = F.when(F.col("size") <= size, drawn).otherwise(most)
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.xxhash64("shingle", F.lit(1)), "shingle"))
    drawn = items.withColumn("place", place).where(F.col("place") <= most)
    return write_shared(drawn.select("item_id", "shingle", F.least(most, "size").alias("drawn")), "sketches")


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """``(doc_id, item_id, matched, size, containment)`` of all pairs at or above the threshold.

    Rows that share a document id count as one document. Rows without id, NULL or short texts and
    empty tables give no pairs. Only ``doc_id`` and ``text``, ``item_id`` and ``text`` are read.

    Items are looked up by broadcast up to a checked size and by a shuffle of shingles beyond it.
    """
    items = item_shingles(benchmark)
    drawn = sketches(items)
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    shingles = word_runs(texts, "doc_id")
    found = lookup(shingles, drawn, "shingle", spread=["doc_id"], how="inner")
    hits = found.groupBy("doc_id", "item_id").agg(F.count_distinct("shingle").alias("n"), F.first("drawn").alias("drawn"))
    near = hits.where(F.col("n") >= F.col("drawn") * (threshold / 2)).select("doc_id", "item_id")
    near = write_shared(near, "candidates")
    ids = near.select("doc_id").distinct()
    some = F.broadcast(ids) if fits_broadcast(near, 16) else ids
    again = word_runs(texts.join(some, "doc_id", "left_semi"), "doc_id")
    both = lookup(again, items, "shingle", spread=["doc_id"], how="inner").join(near, ["doc_id", "item_id"], "left_semi")
    counted = both.groupBy("doc_id", "item_id").agg(
        F.count_distinct("shingle").alias("matched"), F.first("size").alias("size")
    )
    counted = counted.withColumn("containment", F.col("matched") / F.col("size"))
    return counted.where(F.col("containment") >= threshold)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all their columns, that contain no item; rows without id stay."""
    found = write_shared(contaminated(docs, benchmark).select("doc_id").distinct(), "contaminated")
    return docs.join(F.broadcast(found) if fits_broadcast(found, 16) else found, "doc_id", "left_anti")
