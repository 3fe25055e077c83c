"""Mixing sources to target weights by Efraimidis-Spirakis sampling without replacement.

Every document draws the key -ln(u) / weight, u being a hash of its id, so that a run can be
repeated. Within its source, documents are taken in the order of their keys until the prefix sum of their sizes meets
the token budget. A budget above the size of the source takes whole epochs first, and the sample
only fills what is left of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenwin.llm.tables import fresh
from tokenwin.operators.lookup import lookup
from tokenwin.shared import write_shared

WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3
# How often the documents not taken are gone through again for what a long one has left open.
PASSES = 3
_WORD = r"[^\x20\x09-\x0D]+"
_UNIT = float(1 << 52)


def word_count(text: Column | str) -> Column:
    """Runs of other characters than blanks; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def text_weight(text: Column | str) -> Column:
    """Quality of a text between 0.05 and 1: the share of ASCII letters and blanks, 1 if empty."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    odd = F.length(F.regexp_replace(text, r"[A-Za-z \n]+", "")).cast("double")
    return F.greatest(F.lit(0.05), 1.0 - odd / F.greatest(F.length(text), F.lit(1)))


def unit_hash(doc_id: Column | str) -> Column:
    """A number above 0 and below 1 from the MD5 of the id as text; NULL counts as empty."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(_UNIT)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from one row ``(source, source_size)`` for each source.

    Sources in code point order, NULL last, get the weights in turn. Shares of the total size stop
    at ``most_epochs`` times the source and the excess goes to the others by weight, so a target
    is the smaller of that limit and the weight times a level. With sources in the order of
    limit / weight, the level is what the first source that does not reach its limit gets by weight.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    rows = sizes.withColumn("weight", F.element_at(cycle, (place % len(weights) + 1).cast("int")))
    rows = rows.withColumn("limit", F.col("source_size") * F.lit(float(most_epochs)))
    before = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("level", rest / weight)
    # The level sinks from source to source until one stays under its limit.
    fits = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))
    rows = rows.withColumn("level", F.max(fits).over(everything))
    target = F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return rows.select("source", "source_size", target.alias("target"))


def _gaps(rows: DataFrame, most_epochs: int) -> DataFrame:
    """``(name, gap)``: what each source still lacks after whole epochs and the documents taken."""
    got = F.sum(F.when(F.col("taken"), F.col("size")).otherwise(0))
    left = F.first(F.col("target") - F.col("epochs") * F.col("source_size"))
    sums = rows.where(F.col("epochs") < most_epochs).groupBy(F.col("source").alias("name"))
    return sums.agg((left - got).alias("gap"))


def _filled(rows: DataFrame, most_epochs: int) -> DataFrame:
    """Take, in the order of keys, what fits the gap together, of the documents that fit it alone."""
    found = rows.join(_gaps(rows, most_epochs), F.col("source").eqNullSafe(F.col("name")), "left").drop("name")
    fits = ~F.col("taken") & (F.col("size") > 0) & (F.col("size") <= F.col("gap"))
    found = found.withColumn("own", F.when(fits, F.col("size")).otherwise(0))
    sums = found.groupBy("source", "part").agg(F.sum("own").alias("sum"))
    upto = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each source in each task that has it: at most tasks and sources added up.
    starts = sums.select(
        F.col("source").alias("name"), F.col("part").alias("in_part"), F.coalesce(F.sum("sum").over(upto), F.lit(0)).alias("start")
    )
    found = found.join(starts, (F.col("part") == F.col("in_part")) & F.col("source").eqNullSafe(F.col("name")))
    inside = Window.partitionBy("part", "source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("start") + F.sum("own").over(inside)
    taken = F.col("taken") | F.coalesce(fits & (end <= F.col("gap")), F.lit(False))
    return found.withColumn("taken", taken).select(*rows.columns)


def mix(
    docs: DataFrame, size: Column | None = None, weight: Column | None = None,
    weights: tuple[float, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS, keep: list[Column] | None = None,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)`` of every row of ``docs``, and the columns ``keep``.

    ``copies`` is how often the mix repeats the document and ``taken`` the size of all copies. A
    source takes the documents whose prefix sums stay within what is left after whole epochs; a document longer than
    that is passed over. What is left open is filled in the same way ``PASSES`` times in all, and then by the one
    document whose size comes nearest to the gap, if that narrows it. A NULL source is one of its own, apart from the empty name. A NULL text
    has size 0; documents of size 0 are taken like others and add nothing. Rows that repeat an id share its key and
    are ordered by size; an empty table gives no rows. Only ``doc_id``, ``source`` and ``text`` are read.

    The rows without text are range-sorted by source and key over all tasks, and only the sums of
    each source in each task are added up, so one source may hold nearly all rows.
    """
    key = -F.log(unit_hash("doc_id")) / (text_weight("text") if weight is None else weight)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        (word_count("text") if size is None else size).cast("bigint").alias("size"),
        key.alias("key"),
        *(keep or []),
    )
    kept = rows.columns[4:]
    slim = write_shared(rows, "sizes")
    targets = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most_epochs)
    order = [F.col("source").asc_nulls_last(), "key", F.col("doc_id").asc_nulls_last(), "size"]
    sort = slim.orderBy(*order).withColumn("part", F.spark_partition_id())
    placed = write_shared(sort.withColumn("place", F.monotonically_increasing_id()), "sorted")
    named = targets.select(F.col("source").alias("name"), "source_size", "target")
    rows = placed.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rows = rows.withColumn("epochs", F.least(epochs, F.lit(most_epochs)))
    rows = rows.withColumn("taken", F.lit(False))
    for _ in range(PASSES):
        rows = write_shared(_filled(rows, most_epochs), "mix")
    # The one document that fits the gap best closes it.
    gaps = _gaps(rows, most_epochs)
    off = F.abs(F.col("gap") - F.col("size"))
    best = rows.join(gaps, F.col("source").eqNullSafe(F.col("name"))).where((F.col("size") > 0) & ~F.col("taken") & (off < F.col("gap")))
    best = best.groupBy("name").agg(F.min(F.struct(off.alias("off"), "part", "place")).alias("last"))
    best = best.select("name", F.col("last.part").alias("last_part"), F.col("last.place").alias("last_place"))
    same = F.col("source").eqNullSafe(F.col("name"))
    out = rows.join(best, same & (F.col("part") == F.col("last_part")) & (F.col("place") == F.col("last_place")), "left")
    extra = F.when(F.col("taken") | F.col("last_place").isNotNull(), 1).otherwise(0)
    out = out.withColumn("copies", (F.col("epochs") + extra).cast("bigint"))
    columns = ["doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")]
    return out.select(*columns, *kept)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents with all their columns, each row as often as the mix takes it.

    Rows are told apart by two hashes of all their columns, so rows without id and rows that share one count by themselves.
    Rows equal in every column are one, with the copies of all of them.
    """
    names = [fresh(docs.columns, label) for label in ("row", "check", "copies", "copy")]
    row, check, n, at = names
    hashes = [F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), F.xxhash64(F.lit(1), *[F.col(f"`{c}`") for c in docs.columns]).alias(check)]
    mixed = mix(docs, keep=hashes).groupBy(row, check)
    taken = write_shared(mixed.agg(F.sum("copies").alias(n), F.count("*").alias(at)).where(F.col(n) > 0), "copies")
    marked = docs.select("*", *hashes)
    # Documents move only if the rows taken do not fit a broadcast, and those equal to others.
    one = lookup(marked, taken.where(F.col(at) == 1).drop(at), [row, check], spread=["text"], how="inner")
    several = taken.where(F.col(at) > 1).drop(at)
    equal = lookup(marked, several, [row, check], spread=["text"], how="inner").dropDuplicates([row, check])
    rows = one.unionByName(equal)
    return rows.withColumn(at, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns)
