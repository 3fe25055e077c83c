"""Token sequences: ``tokens(seq_id BIGINT, pos BIGINT, token)``, positions dense from 0.

A further column ``seq_len`` is kept where the length of the sequence is known anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenwin.operators.lookup import lookup
from tokenwin.operators.numbering import number_rows, number_rows_within
from tokenwin.shared import remember_arrays, write_shared

# Blank means every character up to U+0020, so tabs and carriage returns too.
_EDGES = r"^[\x00-\x20]+|[\x00-\x20]+$"


def parse_token(line: Column) -> Column:
    """32-bit integer, NULL where the text is not one."""
    return line.try_cast("int").cast("bigint")


def read_token_ids(spark: SparkSession, path: str, on_error: str = "raise") -> DataFrame:
    """Read one integer per line, in line order, files in path order; one sequence in all.

    ``on_error='raise'`` fails the job at the first bad line, ``'skip'`` leaves bad lines out.
    The text is parsed once into a columnar table, which keeps each line's file split and its
    place there; only the line counts of the splits are summed up in one task.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError(f"on_error must be 'raise' or 'skip', not {on_error!r}")
    text = F.regexp_replace("value", _EDGES, "")
    token = parse_token(F.col("text"))
    lines = (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            text.alias("text"),
        )
        .where(F.length("text") > 0)
    )
    if on_error == "skip":
        lines = lines.where(token.isNotNull())
    else:
        problem = F.concat(F.lit("not a 32-bit integer: "), F.col("text"))
        token = F.coalesce(token, F.raise_error(problem).cast("bigint"))
    # Eight bytes stand for the path and place of a split in each line; two splits of one hash would be seen below.
    split = F.xxhash64("file", "start").alias("split")
    numbered = lines.select("file", "start", split, F.monotonically_increasing_id().alias("line"), token.alias("token"))
    names = ["split", "line", "token"]
    placed = write_shared(numbered.select(*names, "file", "start"), "lines")
    splits = placed.groupBy("split").agg(
        F.min(F.struct("file", "start")).alias("first_place"), F.max(F.struct("file", "start")).alias("last_place"),
        F.count("*").alias("n"), F.min("line").alias("first"),
    )
    alike = F.raise_error(F.lit("two file splits have the same hash")).cast("bigint")
    n = F.when(F.col("first_place") == F.col("last_place"), F.col("n")).otherwise(alike)
    in_order = Window.orderBy("first_place.file", "first_place.start")
    shift = F.sum("n").over(in_order) - F.col("n") - F.col("first")
    offsets = write_shared(splits.withColumn("n", n).select("split", shift.alias("shift")), "splits")
    tokens = lookup(placed.select(*names), offsets, "split", spread=["line"], row_bytes=32)
    pos = F.col("line") + F.col("shift")
    # A literal key would be folded away, and later shuffles by sequence would not be reused.
    return tokens.select((pos * 0).alias("seq_id"), pos.alias("pos"), "token")


def _known(token: Column) -> Column:
    """The token, or an error for a NULL one, which no window may hold."""
    return F.when(token.isNull(), F.raise_error(F.lit("a token is NULL"))).otherwise(token)


def tokens_from_table(
    df: DataFrame, order_col: str, token_col: str, seq_col: str | None = None, dense: bool = False
) -> DataFrame:
    """Take sequences from a table.

    With ``dense=True`` the order column already counts 0, 1, 2, ... in each sequence and is the
    position as it stands; a gap raises an error where windows are made. Otherwise rows are numbered
    by it. A NULL token raises an error.
    """
    rows = df.select(
        *([F.col(seq_col).cast("bigint").alias("seq_id")] if seq_col else []),
        F.col(order_col).alias("pos"),
        _known(F.col(token_col)).alias("token"),
    )
    if not dense:
        numbered = (
            number_rows_within(rows, "seq_id", ["pos"], "_pos") if seq_col else number_rows(rows, ["pos"], "_pos")
        )
        rows = numbered.drop("pos").withColumnRenamed("_pos", "pos")
    pos = F.col("pos").cast("bigint")
    return rows.select("seq_id" if seq_col else (pos * 0).alias("seq_id"), pos.alias("pos"), "token")


def tokens_from_arrays(df: DataFrame, seq_col: str, array_col: str) -> DataFrame:
    """One row per array element; the sequence length comes from the array.

    The outer form and the later condition keep the optimizer from testing the array in a filter
    of its own, which would compute an expression such as a split again. Blocks of these tokens are cut out of the arrays.
    """
    tokens = (
        df.select(
            F.col(seq_col).cast("bigint").alias("seq_id"),
            F.size(array_col).cast("bigint").alias("seq_len"),
            F.posexplode_outer(array_col).alias("pos", "token"),
        )
        .where(F.col("pos").isNotNull())
        .select("seq_id", F.col("pos").cast("bigint").alias("pos"), _known(F.col("token")).alias("token"), "seq_len")
    )
    remember_arrays(tokens, df.select(F.col(seq_col).cast("bigint").alias("seq_id"), F.col(array_col).alias("_a")))
    return tokens
