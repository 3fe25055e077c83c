import numpy as np
import pytest
from pyspark.sql import functions as F
from rules import number_tokens, slice_windows
from test_windows import sequences, tokens

from tokenwin.functions.positions import position_matrix
from tokenwin.operators import features, lookup, vocab, windows
from tokenwin.operators.evaluate import matrix

VOCAB = [(10, 0), (20, 1), (30, 2)]
EMB = [(0, [0.1, 0.2]), (1, [0.3, 0.4]), (2, [0.5, 0.6])]


@pytest.fixture
def small(spark):
    return (
        spark.createDataFrame(VOCAB, "token long, idx long"),
        spark.createDataFrame(EMB, "idx long, vec array<float>"),
    )


def test_unknown_token_is_zero(spark, small):
    rows = spark.createDataFrame([(0, 0, 10), (0, 1, 99), (0, 2, 30)], "seq_id long, pos long, token long")
    found = features.embed_sequence(rows, *small, 2).orderBy("pos").collect()
    for row, vec in zip(found, [[0.1, 0.2], [0, 0], [0.5, 0.6]]):
        assert row["vec"] == pytest.approx(vec)


def test_single_targets(spark, small):
    rows = spark.createDataFrame(
        [(0, 0, 1, 2), (0, 1, 20, 2), (1, 0, 1, 2), (1, 1, 99, 2)], "seq_id long, pos long, token long, seq_len long"
    )
    found = features.embed_target(rows, *small, 2, 1, 1).orderBy("seq_id").collect()
    assert found[0]["vec"] == pytest.approx([0.3, 0.4])
    assert found[1]["vec"] == [0.0, 0.0]


def test_index_without_vector_fails(spark, small):
    names, emb = small
    rows = spark.createDataFrame([(0, 0, 20)], "seq_id long, pos long, token long")
    with pytest.raises(Exception, match="no vector for index 1"):
        features.embed_sequence(rows, names, emb.where("idx != 1"), 2).collect()


def test_width(spark, small):
    assert features.embedding_width(small[1]) == 2
    uneven = small[1].union(spark.createDataFrame([(3, [1.0])], "idx long, vec array<float>"))
    with pytest.raises(ValueError, match="1 to 2"):
        features.embedding_width(uneven)
    with pytest.raises(ValueError):
        features.embedding_width(small[1].limit(0))


def inputs(spark, w, s, width=6):
    seqs = sequences(w, s, seed=4)
    rows = tokens(spark, seqs)
    number = number_tokens(seqs, w, s)
    rng = np.random.default_rng(5)
    table = {i: rng.normal(size=width).astype(np.float32) for i in number.values()}
    emb = spark.createDataFrame([(i, v.tolist()) for i, v in table.items()], "idx long, vec array<float>")
    want = {}
    for i, seq in seqs.items():
        for k, x, y in slice_windows(seq, w, s):
            summed = np.stack([table[number[t]] for t in x]) + position_matrix(w, width)
            want[i, k] = (summed, table[number[y]])
    return rows, vocab.build_vocab(rows, w, s), emb, want


@pytest.mark.parametrize("w,s", [(64, 32), (8, 4), (3, 5), (40, 3)])
@pytest.mark.parametrize("packed", [False, True])
def test_examples(spark, w, s, packed):
    rows, names, emb, want = inputs(spark, w, s)
    table = features.training_examples(rows, names, emb, w, s, packed=packed).toArrow()
    got = matrix(table.column("features").combine_chunks())
    labels = matrix(table.column("label").combine_chunks())
    keys = list(zip(table.column("seq_id").to_pylist(), table.column("k").to_pylist()))
    assert sorted(keys) == sorted(want)
    for key, f, label in zip(keys, got, labels):
        assert f == pytest.approx(want[key][0].T.ravel(), abs=1e-6 if packed else 1e-12)
        assert label == pytest.approx(want[key][1])


@pytest.mark.parametrize("w,s", [(8, 4), (3, 5)])
def test_cells_and_sums(spark, w, s):
    rows, names, emb, want = inputs(spark, w, s)
    cells = features.add_positions(features.embed_tokens(rows, names, emb, 6, w, s), 6, w)
    count = 0
    for r in cells.collect():
        assert r["x"] == pytest.approx(want[r["seq_id"], r["k"]][0][r["t"]])
        count += 1
    assert count == len(want) * w
    for r in features.window_features(rows, names, emb, 6, w, s).collect():
        summed = want[r["seq_id"], r["k"]][0]
        assert r["total"] == pytest.approx(summed.sum())
        assert r["total_sq"] == pytest.approx((summed**2).sum())
        assert r["largest"] == pytest.approx(summed.max())
        assert r["cells"] == 6 * w


def test_examples_with_a_large_vocabulary(spark, monkeypatch):
    """The same examples when nothing may be broadcast."""
    rows, names, emb, want = inputs(spark, 8, 4)
    monkeypatch.setattr(lookup, "fits_broadcast", lambda *args, **kwargs: False)
    got = features.training_examples(rows, names, emb, 8, 4).collect()
    assert len(got) == len(want)
    for r in got:
        assert r["features"] == pytest.approx(want[r["seq_id"], r["k"]][0].T.ravel())


def test_second_grouping_reuses_the_block_shuffle(spark):
    rows, names, emb, _ = inputs(spark, 8, 4)
    blocks = features.vector_blocks(rows, names, emb, 6, 8, 4)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "block" in line]
    assert len(shuffled) == 1


def test_position_join_needs_no_shuffle(spark, small):
    cells = spark.createDataFrame([(0, 0, 0, [1.0, 2.0])], "seq_id long, k long, t int, vec array<float>")
    plan = features.add_positions(cells, 2, 4)
    assert "Exchange hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.select(F.size("x")).first()[0] == 2


def test_window_vectors_travel_as_tokens(spark):
    """The exchange on the way to windows of vectors holds tokens alone."""
    rows = tokens(spark, {3: [i % 7 for i in range(300)]})
    names = vocab.build_vocab(windows.with_length(rows), 4, 2)
    emb = names.select("idx", F.array(F.col("idx").cast("float"), F.lit(2.0).cast("float")).alias("vec"))
    found = features.window_vectors(rows, names, emb, 2, 4, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("Exchange hashpartitioning")[1:] if "block" in line.split(")")[0]]
    assert len(exchanges) == 1
    cells = features.add_positions(features.embed_tokens(windows.with_length(rows), names, emb, 2, 4, 2), 2, 4)
    want = cells.groupBy("seq_id", "k").agg(F.sort_array(F.collect_list(F.struct("t", "x"))).alias("r")).select("seq_id", "k", F.col("r.x").alias("rows"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_training_stores_indices_not_vectors(spark):
    """A token takes 4 bytes in the table that training reads, whatever the width; unknown tokens have zero vectors."""
    rows, names, emb, want = inputs(spark, 8, 4, width=6)
    names = names.where("idx != 2")
    plain = features.training_examples(rows, names, emb, 8, 4)
    encoded = features.training_examples(rows, names, emb, 8, 4, packed=True)
    stored = features.encoded_of(encoded).rows
    assert dict(stored.dtypes) == {"seq_id": "bigint", "k": "bigint", "input": "array<int>", "target": "int"}
    assert encoded.dtypes == [("seq_id", "bigint"), ("k", "bigint"), ("features", "binary"), ("label", "array<float>")]
    got = {(r["seq_id"], r["k"]): (np.frombuffer(r["features"], np.float32), r["label"]) for r in encoded.collect()}
    made = {(r["seq_id"], r["k"]): (np.array(r["features"], np.float32), r["label"]) for r in plain.collect()}
    assert got.keys() == made.keys() and len(got) == len(want)
    for key, (f, label) in made.items():
        assert (got[key][0] == f).all() and got[key][1] == label
    with pytest.raises(Exception, match="no vector for index 1"):
        features.training_examples(rows, names, emb.where("idx != 1"), 8, 4, packed=True).collect()


def test_examples_are_stored_whole_where_an_index_has_two_vectors(spark):
    rows, names, emb, _ = inputs(spark, 8, 4)
    twice = emb.union(emb.where("idx = 1"))
    assert features.encoded_of(features.training_examples(rows, names, twice, 8, 4, packed=True)) is None
    assert features.encoded_of(features.training_examples(rows, names, emb, 8, 4)) is None
