import math

import pytest
from pyspark.sql import functions as F

from tokenwin.functions import vectors
from tokenwin.functions.positions import position_matrix, positional_encoding


@pytest.fixture
def pair(spark):
    rows = [(0, [1.0, 2.0, 2.0], [3.0, 0.0, 4.0]), (1, [0.0, 0.0, 0.0], [1.0, 1.0, 1.0])]
    return spark.createDataFrame(rows, "id int, a array<float>, b array<float>")


def values(df, column):
    return [r[0] for r in df.orderBy("id").select(column).collect()]


def test_products(pair):
    assert values(pair, vectors.dot("a", "b")) == [11.0, 0.0]
    assert values(pair, vectors.norm("a")) == [3.0, 0.0]
    assert values(pair, vectors.distance("a", "b")) == pytest.approx([math.sqrt(12), math.sqrt(3)])


def test_cosine_of_zero_vector_is_null(pair):
    assert values(pair, vectors.cosine("a", "b")) == [pytest.approx(11 / 15), None]
    assert pair.where(vectors.cosine("a", "b") > 0.05).count() == 1


def test_array_helpers(pair):
    assert values(pair, vectors.add("a", "b")) == [[4.0, 2.0, 6.0], [1.0, 1.0, 1.0]]
    assert values(pair, vectors.zeros(2)) == [[0.0, 0.0]] * 2
    assert values(pair, vectors.take("a", 2)) == [[1.0, 2.0], [0.0, 0.0]]
    assert values(pair, vectors.last("b")) == [4.0, 1.0]
    assert values(pair, vectors.repeat("id", 3)) == [[0, 0, 0], [1, 1, 1]]
    assert values(pair, vectors.flatten_rows(F.array("a", "b")))[0] == [1.0, 2.0, 2.0, 3.0, 0.0, 4.0]
    assert pair.select(vectors.as_float(vectors.repeat("id", 2)).alias("f")).dtypes == [("f", "array<float>")]


def test_channel_first(pair):
    flat = vectors.channel_first(F.array("a", "b"), 3)
    assert values(pair, flat)[0] == [1.0, 3.0, 2.0, 0.0, 2.0, 4.0]


def test_position_values(spark):
    rows = {r["t"]: r["p"] for r in positional_encoding(spark, 2, 4).collect()}
    assert rows[0] == pytest.approx([0, 1, 0, 1], abs=1e-6)
    second = [math.sin(1), math.cos(1), math.sin(1 / 100), math.cos(1 / 100)]
    assert rows[1] == pytest.approx(second, abs=1e-6)


@pytest.mark.parametrize("window,width", [(64, 64), (5, 7), (3, 1)])
def test_both_position_forms_agree(spark, window, width):
    rows = positional_encoding(spark, window, width).orderBy("t").collect()
    expected = [
        [
            (math.sin if j % 2 == 0 else math.cos)(t / 10000 ** (2 * (j // 2) / width))
            for j in range(width)
        ]
        for t in range(window)
    ]
    for row, values, matrix_row in zip(rows, expected, position_matrix(window, width)):
        assert row["p"] == pytest.approx(values, abs=1e-12)
        assert matrix_row == pytest.approx(values, abs=1e-12)
