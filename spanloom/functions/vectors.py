"""Vector expressions over array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """The inner product of two arrays of equal length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def unit(a: Column, eps: float = 1e-9) -> Column:
    """The array over its length; eps keeps zeros finite."""
    return F.transform(a, lambda x: x.cast("double") / (norm(a) + eps))


def cosine(a: Column, b: Column, eps: float = 1e-9) -> Column:
    return dot(a, b) / (norm(a) * norm(b) + eps)
