"""Vector arithmetic on array columns, for row-wise work on few rows.

Scans of a whole collection use block products in ``operators.search`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.text import bound


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))))


def unit(a: Column) -> Column:
    """The vector at unit length; null for a zero vector."""
    scaled = bound(norm(a), lambda length: F.transform(a, lambda x: x.cast("double") / length))
    return F.when(norm(a) > 0, scaled)


def truncated(a: Column, dims: int) -> Column:
    """The first ``dims`` numbers, brought back to unit length."""
    return unit(F.slice(a, 1, dims))
