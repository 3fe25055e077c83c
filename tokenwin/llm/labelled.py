"""A bounded, repeatable sample of labelled documents to fit classifiers on."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenwin.shared import write_shared


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int
) -> tuple[DataFrame, float]:
    """``(doc_id, text, label, part)`` of at most ``per_class`` labelled ids of each class, written once.

    ``labels`` has ``doc_id`` and the named 0/1 column; ``usable`` tells which ids may be learned
    from. An id with several labels counts with the smallest; rows without id or label are left
    out. ``part`` is a hash of the
    id below 1,000, to split the sample further. Also returns what
    to add to the sample's log odds to get those of all usable labels.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & usable)
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"))
        .withColumn("order", F.xxhash64("doc_id"))
    )
    known = write_shared(known, "labels")
    all_of = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    picked = None
    for c in (0, 1):
        some = known.where(F.col("label") == c).orderBy("order", "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionAll(some)
    # At most twice per_class rows, so they may be broadcast.
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    part = F.pmod(F.xxhash64("order"), F.lit(1000)).cast("int")
    shift = 0.0
    if all_of.get(0) and all_of.get(1):
        shift = math.log(all_of[1] / all_of[0]) - math.log(min(all_of[1], per_class) / min(all_of[0], per_class))
    return write_shared(sample.select("doc_id", "text", "label", part.alias("part")), "sample"), shift
