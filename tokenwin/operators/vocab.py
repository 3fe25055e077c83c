"""Vocabulary: ``vocab(token, idx BIGINT)``, numbered from 1 by first occurrence.

All inputs of all windows come before all targets in that order. Tokens that no full window
covers have no index.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenwin.operators.lookup import lookup
from tokenwin.operators.numbering import number_rows
from tokenwin.operators.windows import target_pairs, window_cells, window_pairs, window_total, with_length
from tokenwin.shared import measured_rows, same_rows, write_shared

UNKNOWN = -1

# A place as one DECIMAL(38, 0) is its sequence times _PLACES plus its position, so places are in the order of their numbers.
# Sequences of targets are moved up beyond all inputs; a sequence without an id comes before all others, as NULL does.
_PLACES = 1 << 56
_TARGETS = 1 << 66
_NO_ID = -(1 << 64)


def _whole(number: int) -> Column:
    return F.lit(Decimal(number))


def _start(seq_id: Column) -> Column:
    return F.coalesce(seq_id.cast("decimal(20,0)"), _whole(_NO_ID))


def _place(is_target: Column) -> Column:
    """The place of a row as one number; a position of more than 16 digits raises an error (NULL without ANSI mode)."""
    start = _start(F.col("seq_id"))
    start = F.when(is_target, start + _whole(_TARGETS)).otherwise(start)
    return start * _whole(_PLACES) + F.col("pos").cast("decimal(16,0)")


def _split_place(df: DataFrame) -> DataFrame:
    """``is_target, seq_id, pos`` of ``_place`` after the token; in steps, so that no number is divided twice."""
    place, own = F.col("_place"), F.col("_own")
    is_target = place >= _whole(_TARGETS // 2 * _PLACES)
    # div rounds towards zero, and positions count upwards from the start of a negative id too.
    floored = F.call_function("div", F.when(own < 0, own - _whole(_PLACES - 1)).otherwise(own), _whole(_PLACES))
    return (
        df.select(
            "token",
            is_target.cast("int").alias("is_target"),
            F.when(is_target, place - _whole(_TARGETS * _PLACES)).otherwise(place).alias("_own"),
        )
        .select("token", "is_target", "_own", F.when(own >= _whole(_NO_ID // 2 * _PLACES), floored).alias("seq_id"))
        .select("token", "is_target", "seq_id", (own - _start(F.col("seq_id")) * _whole(_PLACES)).cast("bigint").alias("pos"))
    )


def distinct_tokens(tokens: DataFrame, w: int, s: int) -> DataFrame:
    """``(token, is_target, seq_id, pos)``: where each windowed token occurs first.

    Within a sequence, window order and position order agree, so a row's place in the order
    follows from its own position. Rows are thus neither exploded nor shuffled before the
    aggregation, and that combines on the map side first. The minimum is one of numbers: a hash table then
    holds a row for each token, where the minimum of a struct would sort all rows of a task.
    """
    # The total is 0 for a sequence too short for a window.
    total = window_total("seq_len", w, s)
    first_input = F.expr(f"greatest(0L, (pos - {w - 1} + {s - 1}) div {s})")
    as_input = (first_input * s <= F.col("pos")) & (first_input < total)
    as_target = F.expr(f"pos >= {w} and (pos - {w}) % {s} = 0") & (F.expr(f"(pos - {w}) div {s}") < total)
    rows = with_length(tokens).where(as_input | as_target)
    return _split_place(rows.groupBy("token").agg(F.min(_place(~as_input)).alias("_place")))


def build_vocab(tokens: DataFrame, w: int, s: int) -> DataFrame:
    """Number the distinct tokens; the result reads a table in the shared folder.

    It is used many times, so it is written in its final form.
    """
    firsts = distinct_tokens(tokens, w, s)
    numbered = number_rows(firsts, ["is_target", "seq_id", "pos"], "_n")
    return write_shared(numbered.select("token", (F.col("_n") + 1).alias("idx")), "vocab")


def vocab_size(vocab: DataFrame) -> DataFrame:
    """Entries plus the reserved index 0."""
    return vocab.agg((F.count("*") + 1).alias("vocab_size"))


def encode(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Replace ``token`` by its index. Done once per token, before windows repeat it."""
    kept = [c for c in tokens.columns if c not in ("token", "idx")]
    known = lookup(tokens, vocab, "token", spread=["seq_id", "pos"], how="inner", row_bytes=64)
    return same_rows(known.select(*kept, F.col("idx").alias("token")), tokens)


def encode_windows(tokens: DataFrame, vocab: DataFrame, w: int, s: int) -> DataFrame:
    """``(seq_id, k, t, idx)``. Lengths are those before tokens without an index drop out."""
    return window_cells(encode(with_length(tokens), vocab), w, s).withColumnRenamed("token", "idx")


def lookup_index(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Add ``idx``, -1 for an unknown token."""
    found = lookup(tokens, vocab, "token", spread=["seq_id", "pos"])
    return same_rows(found.select(*tokens.columns, F.coalesce("idx", F.lit(UNKNOWN).cast("bigint")).alias("idx")), tokens)


def decode_index(df: DataFrame, vocab: DataFrame, spread: list[str], idx: str = "idx", token: str = "token") -> DataFrame:
    """Add the token of an index column, -1 for an index without one."""
    names = vocab.select(F.col("idx").alias(idx), F.col("token").alias(token))
    found = lookup(df, names, idx, spread=spread, counted=vocab)
    return found.select(*df.columns, F.coalesce(token, F.lit(UNKNOWN)).alias(token))


def indexed_tokens(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(seq_id, pos, token)`` with the index as the token; none drops out, so that places stay as they are."""
    measured_rows(tokens, "seq_id")
    found = lookup_index(tokens, vocab)
    return same_rows(found.select("seq_id", "pos", F.col("idx").alias("token")), tokens)


def index_examples(tokens: DataFrame, vocab: DataFrame, w: int, s: int) -> DataFrame:
    """``(seq_id, k, t, input_idx FLOAT, target_idx FLOAT)``, the target repeated at each place."""
    indexed = indexed_tokens(tokens, vocab)
    return target_pairs(window_pairs(indexed, w, s)).select(
        "seq_id",
        "k",
        "t",
        F.col("token").cast("float").alias("input_idx"),
        F.col("target").cast("float").alias("target_idx"),
    )


def unindexed_tokens(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(token, n)``: tokens without an index, counted before the join."""
    counts = tokens.groupBy("token").agg(F.count("*").alias("n"))
    return counts.join(vocab, "token", "left_anti")
