"""Vector arithmetic on array columns, all in DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _double(c: Column) -> Column:
    return c.cast("double")


def dot(a: Column | str, b: Column | str) -> Column:
    return _sum(F.zip_with(_col(a), _col(b), lambda x, y: _double(x) * _double(y)))


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; NULL when a norm is 0, so that no threshold is ever passed."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def distance(a: Column | str, b: Column | str) -> Column:
    squares = F.zip_with(
        _col(a), _col(b), lambda x, y: (_double(x) - _double(y)) * (_double(x) - _double(y))
    )
    return F.sqrt(_sum(squares))


def add(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: _double(x) + _double(y))


def zeros(width: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), width)


def repeat(value: Column | str, times: int) -> Column:
    return F.array_repeat(_col(value), times)


def as_float(a: Column | str) -> Column:
    return _col(a).cast("array<float>")


def take(a: Column | str, n: int) -> Column:
    return F.slice(_col(a), 1, n)


def last(a: Column | str) -> Column:
    return F.element_at(_col(a), -1)


def flatten_rows(rows: Column | str) -> Column:
    return F.flatten(_col(rows))


def channel_first(rows: Column | str, width: int) -> Column:
    """Transpose an array of vectors to one flat array, component by component."""
    return F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(width - 1)),
            lambda j: F.transform(_col(rows), lambda vector: F.get(vector, j)),
        )
    )
