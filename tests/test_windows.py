import random

import pytest
from pyspark.sql import functions as F
from rules import slice_windows

from tokenwin.operators import features, vocab, windows
from tokenwin.sources.tokens import tokens_from_arrays

# Window and stride: overlapping, touching, with gaps, and longer than a block.
SHAPES = [(64, 32), (8, 4), (4, 7), (3, 5), (1, 1), (5, 6), (700, 3), (4, 2500)]


def sequences(w, s, seed=0):
    """Lengths around every edge, and one sequence with a third of all tokens."""
    rng = random.Random(seed)
    lengths = {0, 1, w - 1, w, w + 1, w + s, w + 1 + s, w + 2 * s + 1} | {rng.randrange(4 * (w + s)) for _ in range(12)}
    lengths = sorted(n for n in lengths if n >= 0)
    lengths.append(max(sum(lengths) // 2, 5000))
    return {i: [rng.randrange(1000) for _ in range(n)] for i, n in enumerate(lengths)}


def arrays(spark, seqs):
    return spark.createDataFrame(list(seqs.items()), "id long, words array<long>")


def tokens(spark, seqs, with_length=True):
    df = tokens_from_arrays(arrays(spark, seqs), "id", "words").orderBy(F.rand(1))
    return df if with_length else df.drop("seq_len")


def expected(seqs, w, s):
    return sorted((i, k, x, y) for i, seq in seqs.items() for k, x, y in slice_windows(seq, w, s))


def got(pairs):
    return sorted((r["seq_id"], r["k"], list(r["input"]), r["target"]) for r in pairs.collect())


@pytest.mark.parametrize("w,s", SHAPES)
def test_pairs(spark, w, s):
    seqs = sequences(w, s)
    assert got(windows.window_pairs(tokens(spark, seqs), w, s)) == expected(seqs, w, s)


@pytest.mark.parametrize("w,s", SHAPES)
def test_array_windows(spark, w, s):
    seqs = sequences(w, s)
    assert got(windows.array_windows(arrays(spark, seqs), "id", "words", w, s)) == expected(seqs, w, s)


@pytest.mark.parametrize("w,s", SHAPES[:6])
@pytest.mark.parametrize("with_length", [True, False])
def test_cells(spark, w, s, with_length):
    seqs = sequences(w, s)
    rows = windows.window_cells(tokens(spark, seqs, with_length), w, s).collect()
    want = [(i, k, t, v) for i, k, x, y in expected(seqs, w, s) for t, v in enumerate([*x, y])]
    assert sorted((r["seq_id"], r["k"], r["t"], r["token"]) for r in rows) == sorted(want)


@pytest.mark.parametrize("w,s", SHAPES)
def test_counts_and_targets(spark, w, s):
    seqs = sequences(w, s)
    counts = {r["seq_id"]: r["windows"] for r in windows.window_count(tokens(spark, seqs), w, s).collect()}
    for i, seq in seqs.items():
        n = len(seq)
        formula = (n - (w + 1)) // s + 1 if n >= w + 1 else 0
        assert counts.get(i, 0) == formula == len(slice_windows(seq, w, s))
    rows = windows.window_targets(tokens(spark, seqs), w, s).collect()
    assert sorted((r["seq_id"], r["k"], r["token"]) for r in rows) == [(i, k, y) for i, k, _, y in expected(seqs, w, s)]


@pytest.mark.parametrize("n", [1, 8])
def test_same_result_with_any_partitioning(spark, partitions, n):
    partitions(n)
    seqs = sequences(8, 4)
    assert got(windows.window_pairs(tokens(spark, seqs), 8, 4)) == expected(seqs, 8, 4)


def test_target_pairs(spark):
    pairs = windows.window_pairs(tokens(spark, {0: [5, 6, 7, 8]}), 2, 1)
    rows = windows.target_pairs(pairs).collect()
    assert sorted(tuple(r) for r in rows) == [
        (0, 0, 0, 5, 7), (0, 0, 1, 6, 7), (0, 1, 0, 6, 8), (0, 1, 1, 7, 8),
    ]
    assert windows.window_inputs(pairs).columns == ["seq_id", "k", "input"]
    assert sorted(r["target"] for r in windows.window_labels(pairs).collect()) == [7, 8]


def test_no_windows(spark):
    short = tokens(spark, {0: [1, 2]})
    assert windows.window_pairs(short, 4, 2).collect() == []
    assert windows.window_cells(short, 4, 2).collect() == []


def test_cells_need_no_shuffle(spark):
    plan = windows.window_cells(tokens_from_arrays(arrays(spark, {0: [1]}), "id", "words"), 8, 4)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_blocks_are_bounded(spark):
    """One long sequence is cut into blocks of bounded length."""
    long = spark.range(50000).select(F.lit(0).alias("seq_id"), F.col("id").alias("pos"), F.col("id").alias("token"))
    sizes = windows.token_blocks(long, 64, 32).agg(F.max(F.size("values")), F.count("*")).first()
    assert sizes[0] <= windows.BLOCK_SPAN + 65
    assert sizes[1] >= 24


def test_partitions_follow_measured_rows_through_joins(spark, monkeypatch):
    """Joins that repeat no token change the number of partitions by nothing."""
    monkeypatch.setattr(windows, "BLOCK_TOKENS", 100)
    rows = tokens(spark, {0: list(range(3000)), 1: list(range(500))})
    names = vocab.build_vocab(windows.with_length(rows), 8, 4)
    emb = names.select("idx", F.array(F.lit(1.0).cast("float"), F.lit(2.0).cast("float")).alias("vec"))
    want = 35
    assert windows.block_partitions(rows) == want
    found = vocab.lookup_index(rows, names)
    assert windows.block_partitions(found) == want
    assert windows.block_partitions(vocab.indexed_tokens(rows, names)) == want
    assert windows.block_partitions(features.embed_sequence(found.drop("idx"), names, emb, 2)) == want
    pairs = windows.window_pairs(vocab.indexed_tokens(rows, names), 8, 4)
    assert pairs.rdd.getNumPartitions() == want


@pytest.mark.parametrize("w, s", [(4, 3), (3, 9), (5, 1)])
def test_blocks_of_arrays_are_cut_without_a_shuffle(spark, monkeypatch, w, s):
    monkeypatch.setattr(windows, "BLOCK_SPAN", 8)
    arrays = [(i, [f"{i}.{p}" for p in range(n)]) for i, n in enumerate([0, 1, w, w + 1, w + s, 40, 97])] + [(9, None)]
    rows = tokens_from_arrays(spark.createDataFrame(arrays, "id long, a array<string>"), "id", "a")
    cut = windows.token_blocks(rows, w, s)
    assert "collect_list" not in cut._jdf.queryExecution().toString()
    # Another DataFrame of the same tokens goes through the shuffle.
    shuffled = windows.token_blocks(rows.select("*"), w, s)
    assert cut.dtypes == shuffled.dtypes
    assert sorted(map(tuple, windows.window_pairs(rows, w, s).collect())) == sorted(map(tuple, windows.window_pairs(rows.select("*"), w, s).collect()))
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, shuffled.collect()))


@pytest.mark.parametrize("arrays, error", [([(1, ["a"] * 9), (1, ["b"] * 9)], "positions must count"), ([(1, ["a"] * 9 + [None])], "a token is NULL")])
def test_bad_arrays_raise(spark, arrays, error):
    rows = tokens_from_arrays(spark.createDataFrame(arrays, "id long, a array<string>"), "id", "a")
    with pytest.raises(Exception, match=error):
        windows.window_pairs(rows, 4, 3).collect()
