"""Vector arithmetic over `array<float|double>` columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _doubles(value) -> Column:
    col = value if isinstance(value, Column) else F.col(value)
    return col.cast("array<double>")


def dot(a, b) -> Column:
    """Inner product."""
    products = F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(a) -> Column:
    """Euclidean length."""
    return F.sqrt(
        F.aggregate(_doubles(a), F.lit(0.0), lambda total, x: total + x * x)
    )


def cosine_similarity(a, b) -> Column:
    """Cosine of the angle; NaN if a vector has no length."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(float("nan"))).otherwise(dot(a, b) / size)


def cosine_distance(a, b) -> Column:
    """One minus the cosine."""
    return F.lit(1.0) - cosine_similarity(a, b)


def unit(a) -> Column:
    """The vector scaled to length one; a zero vector stays zero."""
    size = norm(a)
    return F.transform(_doubles(a), lambda x: F.when(size == 0, x).otherwise(x / size))
