"""Strided windows of ``w`` inputs and one target.

Window ``k`` of a sequence covers the positions ``k * s`` to ``k * s + w``; its last element is
the target. Only full windows exist. Place ``t`` runs from 0 to ``w``, and ``t = w`` is the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tokenwin.operators.lookup import lookup
from tokenwin.shared import arrays_of, measured_rows, remember_count, same_rows, write_shared

# Positions that one block covers at least; blocks keep any sequence, however long, off one task.
BLOCK_SPAN = 2048
# Tokens that a partition of blocks holds on average, some 24 MB before vectors are attached.
BLOCK_TOKENS = 1 << 20


def window_total(length: str, w: int, s: int) -> Column:
    """Number of full windows in a sequence."""
    return F.expr(f"if({length} >= {w + 1}, ({length} - {w + 1}) div {s} + 1, 0L)")


def sequence_lengths(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("seq_id").agg(F.count("*").alias("seq_len"))


def with_length(tokens: DataFrame) -> DataFrame:
    """Add ``seq_len`` where the source did not give it."""
    if "seq_len" in tokens.columns:
        return tokens
    ends = tokens.groupBy("seq_id").agg(F.count("*").alias("seq_len"), F.min("pos").alias("_low"), F.max("pos").alias("_high"))
    dense = (F.col("_low") == 0) & (F.col("_high") == F.col("seq_len") - 1)
    length = F.when(dense, F.col("seq_len")).otherwise(F.raise_error(F.lit("positions must count 0, 1, 2, ...")).cast("bigint"))
    seen = Observation()
    lengths = write_shared(ends.select("seq_id", length.alias("seq_len")).observe(seen, F.sum("seq_len").alias("tokens")), "lengths")
    remember_count(tokens, seen.get["tokens"] or 0)
    return same_rows(lookup(tokens, lengths, "seq_id", spread=["pos"], how="inner", row_bytes=32), tokens)


def window_count(tokens: DataFrame, w: int, s: int) -> DataFrame:
    """``(seq_id, seq_len, windows)``"""
    return sequence_lengths(tokens).withColumn("windows", window_total("seq_len", w, s))


def window_cells(tokens: DataFrame, w: int, s: int) -> DataFrame:
    """One row per window and place: ``(seq_id, k, t, ...)`` with all further token columns.

    Each row finds the numbers of its windows from its position alone, so nothing is shuffled.
    """
    first = F.expr(f"greatest(0L, (pos - {w} + {s - 1}) div {s})")
    last = F.least(F.expr(f"pos div {s}"), window_total("seq_len", w, s) - 1)
    rows = with_length(tokens)
    payload = [c for c in rows.columns if c not in ("seq_id", "pos", "seq_len")]
    return (
        rows.select("seq_id", "pos", *payload, first.alias("_first"), last.alias("_last"))
        .where("_first <= _last")
        .select("seq_id", "pos", *payload, F.explode(F.sequence("_first", "_last")).alias("k"))
        .select("seq_id", "k", (F.col("pos") - F.col("k") * s).cast("int").alias("t"), *payload)
    )


def window_targets(tokens: DataFrame, w: int, s: int) -> DataFrame:
    """``(seq_id, k, ...)``: the target row of each window, found without exploding."""
    # A token at this place is the last of a full window, whatever the length of the sequence.
    rows = tokens.where((F.col("pos") >= w) & ((F.col("pos") - w) % s == 0))
    payload = [c for c in rows.columns if c not in ("seq_id", "pos", "seq_len")]
    return rows.select("seq_id", F.expr(f"(pos - {w}) div {s}").alias("k"), *payload)


def windows_per_block(w: int, s: int) -> int:
    """Blocks are several windows long, so that few positions belong to two of them."""
    return max(1, -(-max(BLOCK_SPAN, 4 * w) // s))


def block_partitions(tokens: DataFrame) -> int:
    """As many as the session sets, or one for each ``BLOCK_TOKENS`` rows.

    Rows are measured and carried along with the tokens, since the optimizer's estimate of a join is the
    product of its sides. Tokens of unknown number are counted once.
    """
    pieces = -(-measured_rows(tokens, "seq_id") // BLOCK_TOKENS)
    return max(int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions")), pieces)


def token_blocks(tokens: DataFrame, w: int, s: int, partitions: int | None = None) -> DataFrame:
    """``(seq_id, block, values)``: the tokens that the windows of one block need, in order.

    This is the only shuffle on the way to windows. A block has a bounded length, so one endless
    sequence spreads over all tasks. The number of partitions is set, as the rows are small here
    but the stages after it make many times more data of them than adaptive sizing expects; it grows
    with the measured number of tokens. A gap within a block raises an error. Tokens as they come from arrays
    need no shuffle at all.
    """
    if arrays_of(tokens) is not None:
        return _array_blocks(arrays_of(tokens), w, s)
    n = partitions or block_partitions(tokens)
    per_block = windows_per_block(w, s)
    first = F.expr(f"greatest(0L, (pos - {w} + {s - 1}) div {s}) div {per_block}")
    last = F.expr(f"(pos div {s}) div {per_block}")
    start = F.col("block") * (per_block * s)
    low, high = F.element_at("_cells.pos", 1), F.element_at("_cells.pos", -1)
    dense = (low == start) & (high - low + 1 == F.size("_cells"))
    gap = F.raise_error(F.lit("positions must count 0, 1, 2, ..."))
    return (
        tokens.select("seq_id", "pos", "token", first.alias("_first"), last.alias("_last"))
        .where("_first <= _last")
        .select("seq_id", "pos", "token", F.explode(F.sequence("_first", "_last")).alias("block"))
        .repartition(n, "seq_id", "block")
        .groupBy("seq_id", "block")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("_cells"))
        .select("seq_id", "block", F.when(dense, F.col("_cells.token")).otherwise(gap).alias("values"))
    )


def _array_blocks(arrays: DataFrame, w: int, s: int) -> DataFrame:
    """The same blocks as slices of the arrays, which stay where they are; an id with two arrays raises an error."""
    span = windows_per_block(w, s) * s
    numbers = F.when(F.size("_a") > 0, F.sequence(F.lit(0), F.floor((F.size("_a") - 1) / span).cast("int")))
    pieces = F.transform(numbers, lambda b: F.slice("_a", b * span + 1, span - s + w + 1))
    again = arrays.where(F.size("_a") > 0).groupBy("seq_id").count().agg(F.max("count") > 1).scalar()
    values = (
        F.when(again, F.raise_error(F.lit("positions must count 0, 1, 2, ...")))
        .when(F.exists("values", F.isnull), F.raise_error(F.lit("a token is NULL")))
        .otherwise(F.col("values"))
    )
    # The outer form keeps the arrays from being computed twice, as in array_windows.
    return (
        arrays.select("seq_id", F.posexplode_outer(pieces).alias("block", "values"))
        .where(F.col("block").isNotNull())
        .select("seq_id", F.col("block").cast("bigint").alias("block"), values.alias("values"))
    )


def window_pairs(tokens: DataFrame, w: int, s: int, partitions: int | None = None) -> DataFrame:
    """``(seq_id, k, input ARRAY, target)``"""
    per_block = windows_per_block(w, s)
    numbers = F.sequence(F.lit(0), F.expr(f"least({per_block}, (size(values) - {w + 1}) div {s} + 1) - 1").cast("int"))
    return (
        token_blocks(tokens, w, s, partitions)
        .where(F.size("values") >= w + 1)
        .select("seq_id", "block", "values", F.explode(numbers).alias("_i"))
        .select(
            "seq_id",
            (F.col("block") * per_block + F.col("_i")).alias("k"),
            F.slice("values", F.col("_i") * s + 1, w).alias("input"),
            F.get("values", F.col("_i") * s + w).alias("target"),
        )
    )


def array_windows(df: DataFrame, seq_col: str, array_col: str, w: int, s: int) -> DataFrame:
    """Windows of one array per row, for many short sequences; nothing is shuffled."""
    # Short arrays give NULL and drop out after the explode; a filter on the array itself would be
    # pushed down and compute the array again.
    starts = F.when(F.size("_a") >= w + 1, F.sequence(F.lit(0), F.size("_a") - (w + 1), F.lit(s)))
    pieces = F.transform(starts, lambda i: F.slice("_a", i + 1, w + 1))
    return (
        df.select(F.col(seq_col).alias("seq_id"), F.col(array_col).alias("_a"))
        .select("seq_id", F.posexplode_outer(pieces).alias("k", "_w"))
        .where(F.col("k").isNotNull())
        .select(
            "seq_id",
            F.col("k").cast("bigint").alias("k"),
            F.slice("_w", 1, w).alias("input"),
            F.element_at("_w", w + 1).alias("target"),
        )
    )


def target_pairs(windows: DataFrame) -> DataFrame:
    """``(seq_id, k, t, token, target)``: each input place with the target of its window."""
    return windows.select("seq_id", "k", "target", F.posexplode("input").alias("t", "token")).select(
        "seq_id", "k", "t", "token", "target"
    )


def window_inputs(windows: DataFrame) -> DataFrame:
    return windows.select("seq_id", "k", "input")


def window_labels(windows: DataFrame) -> DataFrame:
    return windows.select("seq_id", "k", "target")
