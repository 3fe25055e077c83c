"""Connected components of a graph of links, contracted in rounds on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenwin.operators.lookup import lookup
from tokenwin.shared import row_count, write_shared


def _moved(rows: DataFrame, parent: DataFrame, column: str, spread: list[str]) -> DataFrame:
    """``rows`` with ``column`` replaced by its parent, if it has one."""
    table = parent.select(F.col("a").alias(column), F.col("p").alias("_p"))
    found = lookup(rows, table, column, spread=spread, counted=parent)
    return found.withColumn(column, F.coalesce("_p", column)).drop("_p")


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` of every id in ``links(a, b)``: the smallest id that links lead to.

    In a round each root takes its smallest neighbour as parent, if that is smaller; chains of parents
    are halved until they end at roots, and links are moved to the roots. Every root with a smaller
    neighbour goes, so at least half of the roots of each part that is left go in two rounds. Links may
    repeat, have either order or join an id to itself; those with a NULL are left out.
    """
    known = links.where("a is not null and b is not null")
    edges = write_shared(
        known.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    ids = known.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    labels = write_shared(ids.select("id", F.col("id").alias("component")), "labels")
    while row_count(edges):
        smaller = edges.select(F.col("b").alias("a"), F.col("a").alias("p"))
        parent = write_shared(smaller.groupBy("a").agg(F.min("p").alias("p")), "parents")
        moved = True
        while moved:
            table = parent.select(F.col("a").alias("p"), F.col("p").alias("_next"))
            jumped = lookup(parent, table, "p", spread=["a"], counted=parent)
            step = F.col("_next").isNotNull()
            jumped = write_shared(jumped.select("a", F.coalesce("_next", "p").alias("p"), step.alias("step")), "parents")
            moved = jumped.where("step").limit(1).count() > 0
            parent = jumped
        labels = write_shared(_moved(labels, parent, "component", ["id"]), "labels")
        moved = _moved(_moved(edges, parent, "a", ["b"]), parent, "b", ["a"])
        moved = moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = write_shared(moved.distinct(), "links")
    return labels
