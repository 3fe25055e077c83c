"""One learned vector per vocabulary index."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenwin.operators.lookup import fits_broadcast
from tokenwin.operators.vocab import UNKNOWN, indexed_tokens
from tokenwin.operators.windows import window_pairs
from tokenwin.shared import row_count, write_shared

# Skip-gram keeps two float vectors per token on the driver and in each task.
MODEL_BYTES = 256 << 20
# Parts that a model is fitted in. Results depend on it, so it does not follow the cluster.
PARTS = 8
# Tokens of a block of vectors, and pairs of tokens that two blocks have on average, for block_skip_gram.
BLOCK_ROWS, BLOCK_PAIRS = 1 << 14, 1 << 20
# Tokens drawn against each pair, pairs of a step, and its length.
_NEGATIVES, _BATCH, _RATE = 5, 256, 0.05
_STATE = "kind int, idx bigint, block int, n double, vec array<float>"


def learn_embeddings(
    tokens: DataFrame, vocab: DataFrame, w: int, s: int, size: int = 50, seed: int = 42, epochs: int = 1,
    method: str = "skip-gram", parts: int = PARTS, max_bytes: int = MODEL_BYTES, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(idx, vec ARRAY<FLOAT>)`` for every index from 1 on.

    ``method`` is 'skip-gram', which raises an error where its model does not fit ``max_bytes``, or
    'blocks' or 'factorize', whose vectors stay distributed throughout. The size of the data never chooses between them.
    """
    if method not in ("skip-gram", "blocks", "factorize"):
        raise ValueError(f"method must be 'skip-gram', 'blocks' or 'factorize', not {method!r}")
    windows = encoded_windows(tokens, vocab, w, s)
    if method == "blocks":
        return block_skip_gram(windows, vocab, size, seed, epochs, block_rows)
    if method == "factorize":
        return factorize(windows, size, seed, epochs, parts)
    if not fits_broadcast(vocab.select("idx"), 8 * size, max_bytes):
        raise ValueError("the skip-gram model is larger than max_bytes; methods 'blocks' and 'factorize' have no such limit")
    return skip_gram(windows, vocab, w, size, seed, epochs, parts)


def encoded_windows(tokens: DataFrame, vocab: DataFrame, w: int, s: int) -> DataFrame:
    """``(seq_id, k, input, target)`` as indices, -1 for a token without one.

    Tokens are encoded before windows repeat them, and none drops out, so that places stay as they are.
    """
    return window_pairs(indexed_tokens(tokens, vocab), w, s)


def skip_gram(windows: DataFrame, vocab: DataFrame, w: int, size: int, seed: int, epochs: int, parts: int) -> DataFrame:
    """Each window is one sentence, and all of it the context of each of its tokens."""
    known = F.filter(F.concat("input", F.array("target")), lambda i: i != UNKNOWN)
    sentences = windows.select(known.cast("array<string>").alias("sentence"))
    model = Word2Vec(
        vectorSize=size, minCount=1, seed=seed, maxIter=epochs, numPartitions=parts, inputCol="sentence",
        windowSize=w, maxSentenceLength=w + 1,
    ).fit(sentences)
    return extract_embeddings(model.getVectors(), vocab)


def extract_embeddings(vectors: DataFrame, vocab: DataFrame) -> DataFrame:
    """Vectors by word, as vectors by index; the reserved index 0 has none."""
    rows = vectors.select(
        F.col("word").cast("bigint").alias("idx"), vector_to_array("vector", dtype="float32").alias("vec")
    )
    return rows.where("idx >= 1").join(vocab.select("idx"), "idx", "left_semi")


def cooccurrence_counts(windows: DataFrame) -> DataFrame:
    """``(a, b, n)``: how often index ``a`` is an input of a window whose target is ``b``; unknown ones are left out."""
    pairs = windows.where(F.col("target") != UNKNOWN).select(F.explode("input").alias("a"), F.col("target").alias("b"))
    return pairs.where(F.col("a") != UNKNOWN).groupBy("a", "b").agg(F.count("*").alias("n"))


def both_ways(windows: DataFrame) -> DataFrame:
    """``(a, b, n)``: how often inputs and targets occur together, counted in both directions."""
    once = cooccurrence_counts(windows)
    both = once.unionByName(once.select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    return both.groupBy("a", "b").agg(F.sum("n").alias("n"))


def block_skip_gram(
    windows: DataFrame, vocab: DataFrame, size: int, seed: int, epochs: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Skip-gram with negative sampling whose model is a table.

    Token vectors and context vectors are dealt into as many blocks each, and the pairs of tokens by both of their
    blocks. In a step every block of token vectors meets another block of context vectors, one diagonal of all the
    meetings, so no two tasks change the same vector; an epoch has as many steps as there are blocks. A task holds two blocks
    and their pairs. The vectors move once a step and the pairs once an epoch.
    """
    pairs = write_shared(both_ways(windows), "pairs")
    ids = write_shared(vocab.select("idx"), "ids")
    blocks = max(1, -(-row_count(ids) // block_rows), math.ceil(math.sqrt(row_count(pairs) / BLOCK_PAIRS)))

    def block(idx: str) -> Column:
        return F.pmod(F.xxhash64(idx), F.lit(blocks)).cast("int")

    diagonal = F.pmod(block("b") - block("a"), F.lit(blocks)).alias("diagonal")
    cells = write_shared(pairs.select("a", "b", F.col("n").cast("double").alias("n"), block("a").alias("g"), diagonal), "cells", ["diagonal"])
    used = pairs.groupBy(F.col("b").alias("idx")).agg(F.sum("n").alias("n"))
    noise = F.pmod(F.xxhash64("idx", "_j", F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20)) - 0.5
    start = ids.select("idx", F.explode(F.sequence(F.lit(1), F.lit(size))).alias("_j")).select("idx", "_j", (noise / size).cast("float").alias("x"))
    start = start.groupBy("idx").agg(F.sort_array(F.collect_list(F.struct("_j", "x"))).alias("_v"))
    tokens = start.select(F.lit(0).alias("kind"), "idx", block("idx").alias("block"), F.lit(0.0).alias("n"), F.col("_v.x").alias("vec"))
    zeros = F.array_repeat(F.lit(0.0).cast("float"), size)
    contexts = ids.join(used, "idx", "left").select(
        F.lit(1).alias("kind"), "idx", block("idx").alias("block"), F.coalesce("n", F.lit(0)).cast("double").alias("n"), zeros.alias("vec")
    )
    state = write_shared(tokens.unionByName(contexts), "vectors")
    for epoch in range(epochs):
        for d in range(blocks):
            group = F.when(F.col("kind") == 0, F.col("block")).otherwise(F.pmod(F.col("block") - d, F.lit(blocks)))
            placed = state.withColumns({"g": group.cast("int"), "other": F.lit(0).cast("bigint")})
            met = cells.where(F.col("diagonal") == d).select(
                F.lit(2).alias("kind"), F.col("a").alias("idx"), F.lit(0).alias("block"), "n", F.lit(None).cast("array<float>").alias("vec"), "g",
                F.col("b").alias("other"),
            )
            met = placed.unionByName(met).groupBy("g")
            state = write_shared(met.applyInArrow(_block_fit([seed, epoch, d]), _STATE), "vectors")
    return state.where("kind = 0").select("idx", "vec")


def _block_fit(seed: list[int]) -> Callable[[pa.Table], pa.Table]:
    return lambda group: _fit_block(group, seed)


def _fit_block(group: pa.Table, seed: list[int]) -> pa.Table:
    """One pass over the pairs of a block of tokens and a block of contexts, pairs drawn by their counts."""
    kind = group.column("kind").to_numpy()
    sides = []
    for k in (0, 1):
        side = group.filter(pa.array(kind == k)).sort_by([("idx", "ascending")])
        vec = side.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        sides.append((side, side.column("idx").to_numpy(), vec.reshape(side.num_rows, -1).astype(np.float32) if side.num_rows else vec))
    (rows, row_ids, w), (columns, column_ids, c) = sides
    pairs = group.filter(pa.array(kind == 2)).sort_by([("idx", "ascending"), ("other", "ascending")])
    if pairs.num_rows:
        a = np.searchsorted(row_ids, pairs.column("idx").to_numpy())
        b = np.searchsorted(column_ids, pairs.column("other").to_numpy())
        often = np.cumsum(pairs.column("n").to_numpy())
        noise = np.cumsum(columns.column("n").to_numpy() ** 0.75)
        rng = np.random.default_rng([*seed, int(row_ids[0])])
        w, c = w.copy(), c.copy()
        for _ in range(-(-len(a) // _BATCH)):
            drawn = np.searchsorted(often, rng.random(_BATCH) * often[-1], "right")
            x, others = a[drawn], np.searchsorted(noise, rng.random((_BATCH, _NEGATIVES)) * noise[-1], "right")
            y = np.concatenate([b[drawn][:, None], others], axis=1)
            error = 1 / (1 + np.exp(-np.einsum("is,ijs->ij", w[x], c[y])))
            error[:, 0] -= 1
            step = np.einsum("ij,ijs->is", error, c[y])
            for vectors, at, by in ((c, y.ravel(), (error[:, :, None] * w[x][:, None, :]).reshape(-1, w.shape[1])), (w, x, step)):
                # A vector drawn n times moves by the sum over the root of n, so that frequent ones stay in bounds.
                met, place, n = np.unique(at, return_inverse=True, return_counts=True)
                total = np.zeros((len(met), vectors.shape[1]), np.float32)
                np.add.at(total, place, by)
                vectors[met] -= _RATE * total / np.sqrt(n)[:, None]
    out = []
    for (side, _, _), vec in zip(sides, (w, c)):
        if side.num_rows:
            offsets = pa.array(np.arange(side.num_rows + 1, dtype=np.int32) * vec.shape[1])
            lists = pa.ListArray.from_arrays(offsets, pa.array(vec.ravel().astype(np.float32)))
            out.append(pa.table([*(side.column(n) for n in ("kind", "idx", "block", "n")), lists], ["kind", "idx", "block", "n", "vec"]))
    schema = pa.schema([("kind", pa.int32()), ("idx", pa.int64()), ("block", pa.int32()), ("n", pa.float64()), ("vec", pa.list_(pa.float32()))])
    return pa.concat_tables([t.cast(schema) for t in out]) if out else schema.empty_table()


def factorize(windows: DataFrame, size: int, seed: int, epochs: int, parts: int) -> DataFrame:
    """Factorize how often inputs and targets occur together, counted in both directions."""
    counts = both_ways(windows).withColumn("n", F.col("n").cast("float"))
    als = ALS(
        rank=size, maxIter=epochs, implicitPrefs=True, seed=seed,
        userCol="a", itemCol="b", ratingCol="n", numUserBlocks=parts, numItemBlocks=parts,
    )
    return als.fit(counts).userFactors.select(F.col("id").cast("bigint").alias("idx"), F.col("features").alias("vec"))
