import pytest
from pyspark.sql import functions as F

from tokenwin.sources.tokens import read_token_ids, tokens_from_arrays, tokens_from_table


def in_order(tokens):
    rows = tokens.orderBy("seq_id", "pos").collect()
    assert [r["pos"] for r in rows] == list(range(len(rows)))
    return [r["token"] for r in rows]


def test_valid_file_keeps_order(spark, tmp_path):
    path = tmp_path / "tokens.txt"
    path.write_text("1\n2\n3\n4\n5\n")
    assert in_order(read_token_ids(spark, str(path))) == [1, 2, 3, 4, 5]


def test_empty_file(spark, tmp_path):
    path = tmp_path / "tokens.txt"
    path.write_text("")
    assert in_order(read_token_ids(spark, str(path))) == []


UNTIDY = "\n\t\n 7 \n+5\r\n\x01 9\t\n-3\n"


def test_blanks_and_signs(spark, tmp_path):
    path = tmp_path / "tokens.txt"
    path.write_text(UNTIDY)
    assert in_order(read_token_ids(spark, str(path))) == [7, 5, 9, -3]


@pytest.mark.parametrize("bad", ["x1", "3.5", "99999999999", "1 2"])
def test_bad_line_raises_or_is_skipped(spark, tmp_path, bad):
    path = tmp_path / "tokens.txt"
    path.write_text(f"1\n{bad}\n2\n")
    with pytest.raises(Exception, match="not a 32-bit integer"):
        read_token_ids(spark, str(path))
    assert in_order(read_token_ids(spark, str(path), on_error="skip")) == [1, 2]


def test_unknown_policy(spark, tmp_path):
    with pytest.raises(ValueError, match="on_error"):
        read_token_ids(spark, str(tmp_path), on_error="ignore")


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(Exception):
        read_token_ids(spark, str(tmp_path / "none.txt"))


def test_order_over_files_and_splits(spark, tmp_path):
    """Files of different sizes, each cut into many splits that are packed out of order."""
    sizes = [50, 700, 3, 400]
    values = iter(range(sum(sizes)))
    for i, size in enumerate(sizes):
        (tmp_path / f"part-{i}.txt").write_text("".join(f"{next(values)}\n" for _ in range(size)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        tokens = read_token_ids(spark, str(tmp_path))
        assert in_order(tokens) == list(range(sum(sizes)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_table_numbered_by_order(spark):
    df = spark.createDataFrame([(30, 1), (10, 2), (20, 3)], "at int, token long")
    assert in_order(tokens_from_table(df, "at", "token")) == [2, 3, 1]


def test_dense_table_keeps_positions(spark):
    df = spark.createDataFrame([(2, 1), (0, 2), (1, 3)], "at int, token long")
    assert in_order(tokens_from_table(df, "at", "token", dense=True)) == [2, 3, 1]


@pytest.mark.parametrize("n", [1, 8])
def test_table_of_sequences_with_a_hot_one(spark, partitions, n):
    partitions(n)
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("s"),
        (F.lit(10000) - F.col("id")).alias("at"),
        F.col("id").alias("token"),
    )
    rows = tokens_from_table(df, "at", "token", "s").collect()
    by_seq = {}
    for r in sorted(rows, key=lambda r: (r["seq_id"], r["pos"])):
        by_seq.setdefault(r["seq_id"], []).append((r["pos"], r["token"]))
    assert sum(map(len, by_seq.values())) == 3000
    for seq in by_seq.values():
        assert [p for p, _ in seq] == list(range(len(seq)))
        assert [t for _, t in seq] == sorted((t for _, t in seq), reverse=True)


def test_arrays(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "id long, words array<string>")
    assert [tuple(r) for r in tokens_from_arrays(df, "id", "words").orderBy("pos").collect()] == [
        (1, 0, "a", 2),
        (1, 1, "b", 2),
    ]
