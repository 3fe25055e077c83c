import numpy as np
import pytest
from pyspark.sql import functions as F
from test_windows import sequences, tokens

from tokenwin.operators import embed_learning, vocab
from tokenwin.operators.embed_learning import cooccurrence_counts, encoded_windows, learn_embeddings
from tokenwin.operators.windows import with_length


@pytest.mark.parametrize("method", ["skip-gram", "blocks", "factorize"])
def test_one_vector_per_index(spark, method):
    rows = tokens(spark, sequences(8, 4, seed=6))
    names = vocab.build_vocab(rows, 8, 4)
    emb = learn_embeddings(rows, names, 8, 4, size=5, method=method)
    assert dict(emb.dtypes) == {"idx": "bigint", "vec": "array<float>"}
    got = emb.collect()
    size = names.count()
    assert sorted(r["idx"] for r in got) == list(range(1, size + 1))
    assert all(len(r["vec"]) == 5 for r in got)


def test_size_never_chooses_the_method(spark):
    rows = tokens(spark, sequences(8, 4, seed=6))
    names = vocab.build_vocab(rows, 8, 4)
    with pytest.raises(ValueError, match="larger than max_bytes"):
        learn_embeddings(rows, names, 8, 4, size=5, max_bytes=0)
    with pytest.raises(ValueError, match="method must be"):
        learn_embeddings(rows, names, 8, 4, method="other")


def test_windows_with_gaps_keep_their_places(spark):
    rows = spark.range(2000).select(F.lit(0).cast("bigint").alias("seq_id"), F.col("id").alias("pos"), F.col("id").alias("token"))
    names = vocab.build_vocab(rows, 4, 97)
    back = {r["idx"]: r["token"] for r in names.collect()}
    found = {r["k"]: r for r in encoded_windows(rows, names, 4, 97).collect()}
    assert len(found) == 21
    for k, r in found.items():
        assert [back[i] for i in [*r["input"], r["target"]]] == list(range(97 * k, 97 * k + 5))


def test_long_windows_are_not_cut(spark):
    rows = spark.range(2402).select(F.lit(0).cast("bigint").alias("seq_id"), F.col("id").alias("pos"), (F.col("id") % 7).alias("token"))
    names = vocab.build_vocab(rows, 1200, 1201)
    counts = cooccurrence_counts(encoded_windows(rows, names, 1200, 1201))
    assert counts.agg(F.sum("n")).first()[0] == 2 * 1200


def test_tokens_used_alike_come_out_close(spark):
    rng = np.random.default_rng(0)
    # Tokens 0 and 1 stand among 10 to 13, tokens 2 and 3 among 20 to 23.
    values = []
    for _ in range(400):
        side = int(rng.integers(2))
        values += [int(rng.integers(2)) + 2 * side, *(int(rng.integers(4)) + 10 * (side + 1) for _ in range(3))]
    rows = spark.createDataFrame([(0, p, v) for p, v in enumerate(values)], "seq_id bigint, pos bigint, token bigint")
    names = vocab.build_vocab(rows, 3, 4)
    idx = {r["token"]: r["idx"] for r in names.collect()}
    for method in ("skip-gram", "factorize", "blocks"):
        # Blocks of five tokens: three steps an epoch, and no model on the driver.
        more = {"block_rows": 5, "epochs": 12, "max_bytes": 0} if method == "blocks" else {"epochs": 8}
        emb = learn_embeddings(rows, names, 3, 4, size=6, method=method, parts=1, **more)
        vec = {r["idx"]: np.array(r["vec"]) / np.linalg.norm(r["vec"]) for r in emb.collect()}
        near = vec[idx[0]] @ vec[idx[1]] + vec[idx[2]] @ vec[idx[3]]
        far = vec[idx[0]] @ vec[idx[2]] + vec[idx[1]] @ vec[idx[3]]
        assert near > far


def test_gaps_and_missing_tokens_raise(spark):
    from tokenwin.operators.windows import window_pairs
    from tokenwin.sources.tokens import tokens_from_table

    holes = spark.range(100).select((F.col("id") * 2).alias("p"), F.col("id").alias("v"))
    rows = tokens_from_table(holes, "p", "v", dense=True)
    for windows in (lambda: window_pairs(rows, 4, 4).collect(), lambda: with_length(rows).collect()):
        with pytest.raises(Exception, match="positions must count"):
            windows()
    missing = spark.range(100).select("id", F.when(F.col("id") != 50, F.col("id")).alias("v"))
    with pytest.raises(Exception, match="a token is NULL"):
        tokens_from_table(missing, "id", "v", dense=True).collect()


def test_a_block_step_changes_its_own_vectors_alone():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    rows = [(k, i, 0, 3.0, rng.normal(size=4).astype(np.float32).tolist(), 0, 0) for k in (0, 1) for i in (3, 1, 8)]
    rows += [(2, a, 0, float(n), None, 0, b) for a, b, n in ((1, 3, 5), (8, 8, 1))]
    names = ["kind", "idx", "block", "n", "vec", "g", "other"]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.float64(), pa.list_(pa.float32()), pa.int32(), pa.int64()]
    group = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
    out = embed_learning._fit_block(group, [1, 0, 0]).to_pylist()
    before = {(r["kind"], r["idx"]): r["vec"] for r in group.to_pylist()}
    after = {(r["kind"], r["idx"]): r["vec"] for r in out}
    assert after.keys() == {key for key in before if key[0] < 2}
    assert after[0, 3] == before[0, 3] and after[0, 1] != before[0, 1] and after[0, 8] != before[0, 8]
    assert embed_learning._fit_block(group.slice(0, 6), [1, 0, 0]).to_pylist()[0]["vec"] == before[0, 1]
