"""Array arithmetic kept in built-in higher-order functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def distance2(a: Column, b: Column) -> Column:
    gap = lambda x, y: x.cast("double") - y.cast("double")
    return total(F.zip_with(a, b, lambda x, y: gap(x, y) * gap(x, y)))


def cosine(a: Column, b: Column, eps: float = 1e-9) -> Column:
    """Dot product of the two vectors, each divided by (its norm + eps)."""
    return dot(a, b) / ((norm(a) + eps) * (norm(b) + eps))


def cross(a: tuple, b: tuple) -> tuple[Column, Column, Column]:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def inner(a: tuple, b: tuple) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def minus(a: tuple, b: tuple) -> tuple[Column, Column, Column]:
    return (a[0] - b[0], a[1] - b[1], a[2] - b[2])
