"""Training features: token vectors plus position vectors.

``emb(idx BIGINT, vec ARRAY<FLOAT>)`` holds one vector per vocabulary index.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenwin.functions import vectors
from tokenwin.functions.positions import position_matrix, positional_encoding
from tokenwin.operators.lookup import lookup
from tokenwin.operators.vector_table import SharedVectors, shared_vectors
from tokenwin.operators.vocab import indexed_tokens
from tokenwin.operators.windows import token_blocks, window_cells, window_pairs, window_targets, windows_per_block
from tokenwin.shared import same_rows, write_shared

# Size of one Arrow batch of examples that a task hands back.
_BATCH_BYTES = 32 << 20


def embedding_width(emb: DataFrame) -> int:
    low, high = emb.agg(F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if low is None or low != high:
        raise ValueError(f"embedding widths must be equal, found {low} to {high}")
    return high


def token_vectors(vocab: DataFrame, emb: DataFrame) -> DataFrame:
    """``(token, idx, vec)``; fails at an index that has no vector."""
    missing = F.raise_error(F.concat(F.lit("no vector for index "), F.col("idx").cast("string")))
    joined = vocab.join(emb, "idx", "left")
    return joined.select("token", "idx", F.coalesce("vec", missing.cast("array<float>")).alias("vec"))


def _attach(rows: DataFrame, vocab: DataFrame, emb: DataFrame, width: int, spread: list[str]) -> DataFrame:
    """Add ``vec``, a zero vector for an unknown token."""
    table = token_vectors(vocab, emb).select("token", "vec")
    found = lookup(rows, table, "token", spread=spread, row_bytes=64 + 4 * width, counted=vocab)
    return same_rows(found.select(*rows.columns, F.coalesce("vec", vectors.zeros(width)).alias("vec")), rows)


def embed_sequence(tokens: DataFrame, vocab: DataFrame, emb: DataFrame, width: int) -> DataFrame:
    """Add ``vec`` to each token row."""
    return _attach(tokens, vocab, emb, width, ["seq_id", "pos"])


def embed_tokens(tokens: DataFrame, vocab: DataFrame, emb: DataFrame, width: int, w: int, s: int) -> DataFrame:
    """``(seq_id, k, t, token, vec)`` for every input place of every window."""
    return window_cells(embed_sequence(tokens, vocab, emb, width), w, s).where(F.col("t") < w)


def embed_target(tokens: DataFrame, vocab: DataFrame, emb: DataFrame, width: int, w: int, s: int) -> DataFrame:
    """``(seq_id, k, token, vec)`` for the target of every window."""
    return _attach(window_targets(tokens, w, s), vocab, emb, width, ["seq_id", "k"])


def with_positions(cells: DataFrame, width: int, w: int) -> DataFrame:
    """Add the position vector ``p`` of place ``t``; the table has ``w`` rows, whatever the data."""
    return cells.join(F.broadcast(positional_encoding(cells.sparkSession, w, width)), "t")


def add_positions(cells: DataFrame, width: int, w: int) -> DataFrame:
    """Add ``x ARRAY<DOUBLE>``, the sum of token and position vector."""
    return with_positions(cells, width, w).withColumn("x", vectors.add("vec", "p")).drop("p")


def feature_values(cells: DataFrame, width: int, w: int) -> DataFrame:
    """``(seq_id, k, t, j, c)``: the same sums as scalars, for aggregation without array work."""
    return (
        with_positions(cells, width, w)
        .select("seq_id", "k", "t", "p", F.posexplode("vec").alias("j", "_x"))
        .select("seq_id", "k", "t", "j", (F.col("_x").cast("double") + F.get("p", F.col("j"))).alias("c"))
    )


def window_features(tokens: DataFrame, vocab: DataFrame, emb: DataFrame, width: int, w: int, s: int) -> DataFrame:
    """Sum, sum of squares, maximum and count of the feature cells of each window."""
    cells = feature_values(embed_tokens(tokens, vocab, emb, width, w, s), width, w)
    return cells.groupBy("seq_id", "k").agg(
        F.sum("c").alias("total"),
        F.sum(F.col("c") * F.col("c")).alias("total_sq"),
        F.max("c").alias("largest"),
        F.count("*").alias("cells"),
    )


def channel_first(rows: Column | str, width: int) -> Column:
    return vectors.channel_first(rows, width)


def vector_blocks(
    tokens: DataFrame, vocab: DataFrame, emb: DataFrame, width: int, w: int, s: int, partitions: int | None = None
) -> DataFrame:
    """``(seq_id, block, flat)``: the vectors of a block's tokens, one after the other.

    Each position is looked up once, not once per window. With a broadcast lookup the rows stay
    where the block shuffle put them, and the second grouping needs no further shuffle.
    """
    cells = token_blocks(tokens, w, s, partitions).select("seq_id", "block", F.posexplode("values").alias("pos", "token"))
    embedded = _attach(cells, vocab, emb, width, ["seq_id", "block", "pos"])
    return (
        embedded.groupBy("seq_id", "block")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "vec"))).alias("_cells"))
        .select("seq_id", "block", F.flatten("_cells.vec").alias("flat"))
    )


def _windows_of_blocks(
    batches: Iterator[pa.RecordBatch], width: int, w: int, s: int
) -> Iterator[tuple[list[pa.Array], np.ndarray]]:
    """Keys of some windows and their vectors as (window, component, place), the target last; a strided view of the block."""
    per_block = windows_per_block(w, s)
    step = max(1, _BATCH_BYTES // (8 * width * (w + 1)))
    for batch in batches:
        for seq_id, block, flat in zip(*(batch.column(c) for c in ("seq_id", "block", "flat"))):
            vecs = flat.values.to_numpy(zero_copy_only=False).reshape(-1, width)
            if len(vecs) <= w:
                continue
            views = np.lib.stride_tricks.sliding_window_view(vecs, w + 1, axis=0)[::s][:per_block]
            for i in range(0, len(views), step):
                part = views[i : i + step]
                k = block.as_py() * per_block + i + np.arange(len(part))
                yield [pa.array(np.full(len(part), seq_id.as_py())), pa.array(k)], part


def lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values).ravel()))


def packed_rows(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in values.astype(np.float32)], pa.binary())


def window_vectors(tokens: DataFrame, vocab: DataFrame, emb: DataFrame, width: int, w: int, s: int) -> DataFrame:
    """``(seq_id, k, rows ARRAY<ARRAY<DOUBLE>>)``: the sums of token and position vectors at the input places.

    The blocks' tokens are shuffled, not their vectors: a window cuts its rows out of its block, where the lookup
    put them.
    """
    positions = position_matrix(w, width)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, part in _windows_of_blocks(batches, width, w, s):
            inner = lists((part[:, :, :w].transpose(0, 2, 1) + positions).reshape(-1, width))
            offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * w)
            yield pa.RecordBatch.from_arrays([*key, pa.ListArray.from_arrays(offsets, inner)], names=["seq_id", "k", "rows"])

    blocks = vector_blocks(tokens, vocab, emb, width, w, s)
    return blocks.mapInArrow(rows, "seq_id bigint, k bigint, rows array<array<double>>")


def training_examples(
    tokens: DataFrame,
    vocab: DataFrame,
    emb: DataFrame,
    w: int,
    s: int,
    width: int | None = None,
    partitions: int | None = None,
    packed: bool = False,
) -> DataFrame:
    """``(seq_id, k, features ARRAY<DOUBLE>, label ARRAY<FLOAT>)``

    Features are channel-first: component 0 at all ``w`` places, then component 1, and so on. The
    sums of a block are one numpy addition over a strided view; an array lambda took twice as long.
    ``packed=True`` gives the features as BINARY of FLOAT values, which is what training reads:
    thousands of array elements per row are slow to write, shuffle and read. Where the vectors may be sent to every
    task, only the indices of the tokens are written, and training makes the features of them; see ``encoded_of``.
    """
    width = width or embedding_width(emb)
    positions = position_matrix(w, width).T
    if packed:
        shared = shared_vectors(emb, width)
        if shared and shared.unique and shared.largest < 1 << 31:
            return _encoded_examples(tokens, vocab, emb, shared, w, s, width, partitions).frame(["features", "label"])

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, part in _windows_of_blocks(batches, width, w, s):
            features = (part[:, :, :w] + positions).reshape(len(part), -1)
            values = packed_rows(features) if packed else lists(features)
            yield pa.RecordBatch.from_arrays([*key, values, lists(part[:, :, w])], names=["seq_id", "k", "features", "label"])

    blocks = vector_blocks(tokens, vocab, emb, width, w, s, partitions)
    kind = "binary" if packed else "array<double>"
    return blocks.mapInArrow(examples, f"seq_id bigint, k bigint, features {kind}, label array<float>")


@dataclass(frozen=True)
class EncodedExamples:
    """Examples as the indices of their tokens, ``rows(..., input ARRAY<INT>, target INT)``.

    An index takes 4 bytes where the features hold a vector, and stands in the table once for each window. Features
    and labels are made of the shared vectors by whatever task needs them.
    """

    rows: DataFrame
    vectors: SharedVectors
    places: int
    width: int

    def maker(self) -> Callable[[np.ndarray, str], np.ndarray]:
        """Makes the ``features`` of some ``indices``, one row of values each, or their ``label``; both as FLOAT."""
        table, w, positions = self.vectors.table, self.places, position_matrix(self.places, self.width).T

        def make(cells: np.ndarray, name: str) -> np.ndarray:
            if name == "label":
                return table.value.of(cells[:, w]).astype(np.float32, copy=False)
            x = table.value.of(cells[:, :w])
            return (x.transpose(0, 2, 1) + positions).astype(np.float32).reshape(len(cells), -1)

        return make

    def step(self) -> int:
        """Rows whose features take bounded memory."""
        return max(1, _BATCH_BYTES // (8 * self.width * (self.places + 1)))

    def frame(self, names: list[str]) -> DataFrame:
        """The other columns of the rows, and those of ``features`` (BINARY) and ``label`` that are named."""
        make, step = self.maker(), self.step()
        kept = [c for c in self.rows.columns if c not in ("input", "target")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in (batch.slice(i, step) for i in range(0, batch.num_rows, step)):
                    made = [(packed_rows if n == "features" else lists)(make(indices(part), n)) for n in names]
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *made], names=[*kept, *names])

        fields = [f"{n} {'binary' if n == 'features' else 'array<float>'}" for n in names]
        types = [f"`{f.name}` {f.dataType.simpleString()}" for f in self.rows.select(*kept).schema]
        found = same_rows(self.rows.mapInArrow(run, ", ".join([*types, *fields])), self.rows)
        _encoded[found] = self
        return found


def indices(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
    """A row of indices for each example, its target last."""
    given, target = rows.column("input"), rows.column("target")
    if isinstance(given, pa.ChunkedArray):
        given = given.combine_chunks()
    return np.column_stack([given.flatten().to_numpy().reshape(len(given), -1), target.to_numpy()])


_encoded: WeakKeyDictionary[DataFrame, EncodedExamples] = WeakKeyDictionary()


def encoded_of(examples: DataFrame) -> EncodedExamples | None:
    """What examples of ``training_examples`` are made of; None for any other DataFrame."""
    return _encoded.get(examples)


def _encoded_examples(
    tokens: DataFrame, vocab: DataFrame, emb: DataFrame, shared: SharedVectors, w: int, s: int, width: int, partitions: int | None
) -> EncodedExamples:
    """The windows of the tokens' indices, written once; fails at an index that has no vector."""
    token_vectors(vocab, emb).agg(F.max(F.size("vec"))).collect()
    pairs = window_pairs(indexed_tokens(tokens, vocab), w, s, partitions)
    rows = pairs.select(
        F.col("seq_id").cast("bigint").alias("seq_id"), F.col("k").cast("bigint").alias("k"),
        F.col("input").cast("array<int>").alias("input"), F.col("target").cast("int").alias("target"),
    )
    return EncodedExamples(write_shared(rows, "windows"), shared, w, width)
