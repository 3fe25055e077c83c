import random

import pytest
from pyspark.sql import functions as F
from rules import number_tokens, slice_windows
from test_windows import SHAPES, sequences, tokens

from tokenwin.operators import vocab
from tokenwin.operators.numbering import number_rows


def as_dict(names):
    rows = names.collect()
    result = {r["token"]: r["idx"] for r in rows}
    assert len(result) == len(rows)
    return result


@pytest.mark.parametrize("w,s", SHAPES)
def test_order_of_first_occurrence(spark, w, s):
    seqs = sequences(w, s, seed=1)
    assert as_dict(vocab.build_vocab(tokens(spark, seqs), w, s)) == number_tokens(seqs, w, s)


@pytest.mark.parametrize("n", [1, 8])
def test_numbering_with_any_partitioning(spark, partitions, n):
    partitions(n)
    seqs = {0: [random.Random(3).randrange(400) for _ in range(3000)]}
    assert as_dict(vocab.build_vocab(tokens(spark, seqs, with_length=False), 8, 4)) == number_tokens(seqs, 8, 4)


def test_targets_come_after_all_inputs(spark):
    # 9 occurs first as a target, but inputs of the later window come before it.
    seqs = {0: [1, 2, 9, 3, 4, 5]}
    assert as_dict(vocab.build_vocab(tokens(spark, seqs), 2, 3)) == {1: 1, 2: 2, 3: 3, 4: 4, 9: 5, 5: 6}


def test_uncovered_tokens_have_no_index(spark):
    seqs = {0: [1, 1, 1, 7, 8, 2, 2, 2, 9]}
    rows = tokens(spark, seqs)
    names = vocab.build_vocab(rows, 2, 5)
    assert as_dict(names) == {1: 1, 2: 2}
    missing = {r["token"]: r["n"] for r in vocab.unindexed_tokens(rows, names).collect()}
    assert missing == {7: 1, 8: 1, 9: 1}
    assert vocab.vocab_size(names).first()[0] == 3


def test_lookup_and_decode(spark):
    names = spark.createDataFrame([(10, 1), (20, 2)], "token long, idx long")
    rows = spark.createDataFrame([(0, 0, 20), (0, 1, 99)], "seq_id long, pos long, token long")
    assert [r["idx"] for r in vocab.lookup_index(rows, names).orderBy("pos").collect()] == [2, -1]
    found = vocab.decode_index(spark.createDataFrame([(1,), (5,), (None,)], "idx long"), names, ["idx"])
    assert {r["idx"]: r["token"] for r in found.collect()} == {1: 10, 5: -1, None: -1}


@pytest.mark.parametrize("w,s", [(8, 4), (3, 5)])
def test_encoded_windows_and_examples(spark, w, s):
    seqs = sequences(w, s, seed=2)
    rows = tokens(spark, seqs)
    names = vocab.build_vocab(rows, w, s)
    number = number_tokens(seqs, w, s)
    windows = [(i, k, x, y) for i, seq in seqs.items() for k, x, y in slice_windows(seq, w, s)]
    cells = vocab.encode_windows(rows, names, w, s).collect()
    want = [(i, k, t, number[v]) for i, k, x, y in windows for t, v in enumerate([*x, y])]
    assert sorted((r["seq_id"], r["k"], r["t"], r["idx"]) for r in cells) == sorted(want)
    examples = vocab.index_examples(rows, names, w, s)
    assert dict(examples.dtypes)["input_idx"] == dict(examples.dtypes)["target_idx"] == "float"
    want = [(i, k, t, float(number[v]), float(number[y])) for i, k, x, y in windows for t, v in enumerate(x)]
    assert sorted(tuple(r) for r in examples.collect()) == sorted(want)


def test_number_rows_is_dense(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"))
    rows = number_rows(df, ["v"], "n").orderBy("v").collect()
    assert [r["n"] for r in rows] == list(range(5000))


def test_numbering_of_nothing(spark):
    assert number_rows(spark.range(0), ["id"], "n").collect() == []


def test_first_places_need_no_sort(spark):
    # A minimum of structs would sort all tokens of a task before it sums them up.
    rows = tokens(spark, {0: [1, 2, 3] * 4})
    plan = vocab.distinct_tokens(rows, 2, 2)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("w,s", [(3, 2), (2, 5)])
def test_first_places_of_odd_ids(spark, ansi, w, s):
    # NULL ids come first, then by number; ids that come twice, a NULL token and sequences too short for a window.
    ids = [None, -(2**63), -(2**63) + 1, -3, -1, 0, 0, 1, 2**40, 2**63 - 1]
    seqs = [(i, [n % 4, n, 50, None, 7, 100 + n, 60 + n % 3, 200 + n]) for n, i in enumerate(ids)] + [(5, []), (6, [1, 2])]
    table = [(i, p, t, len(seq)) for i, seq in seqs for p, t in enumerate(seq)]
    rows = spark.createDataFrame(random.Random(w).sample(table, len(table)), "seq_id long, pos long, token long, seq_len long")
    want = {}
    for i, seq in seqs:
        starts = range(0, max(0, len(seq) - w), s)
        for is_target, places in ((0, {k + t for k in starts for t in range(w)}), (1, {k + w for k in starts})):
            for p in places:
                place = (is_target, i is not None, i or 0, p)
                want[seq[p]] = min(place, want.get(seq[p], place))
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        found = vocab.distinct_tokens(rows, w, s)
        assert dict(found.dtypes) == {"token": "bigint", "is_target": "int", "seq_id": "bigint", "pos": "bigint"}
        got = [(r["token"], (r["is_target"], r["seq_id"] is not None, r["seq_id"] or 0, r["pos"])) for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert len(got) == len(want) and dict(got) == want
    assert any(place[0] for place in want.values()) and any(not place[1] for place in want.values())


def test_first_places_of_long_sequences(spark):
    rows = spark.createDataFrame([(-1, 10**16 - 2, 5, 10**16), (-2, 10**15, 5, 10**16)], "seq_id long, pos long, token long, seq_len long")
    assert [tuple(r) for r in vocab.distinct_tokens(rows, 1, 1).collect()] == [(5, 0, -2, 10**15)]
    assert [tuple(r) for r in vocab.distinct_tokens(rows.where("seq_id = -1"), 1, 1).collect()] == [(5, 0, -1, 10**16 - 2)]
