"""Vector expressions on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _double(a: Column | str) -> Column:
    return (F.col(a) if isinstance(a, str) else a).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_double(a), _double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def normalise(a: Column | str) -> Column:
    """Unit vector; a zero vector stays zero."""
    length = norm(a)
    return F.transform(_double(a), lambda x: F.when(length > 0, x / length).otherwise(F.lit(0.0)))


def cosine(a: Column | str, b: Column | str) -> Column:
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))
