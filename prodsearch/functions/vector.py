"""Vector expressions on ``array<float|double>`` columns (no built-ins exist)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of


def as_double(v: str | Column) -> Column:
    return col_of(v).cast("array<double>")


def dot(a: str | Column, b: str | Column) -> Column:
    """Sum of element products, computed in double."""
    prods = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(v: str | Column) -> Column:
    d = as_double(v)
    return F.sqrt(F.aggregate(d, F.lit(0.0).cast("double"), lambda acc, x: acc + x * x))


def l2_normalize(v: str | Column) -> Column:
    """Unit-length copy of the vector; null for a zero (or null) vector.
    As one expression the norm is evaluated per element; on a DataFrame,
    ``operators.retrieve.l2_normalize`` computes it once per row."""
    n = norm(v)
    return F.when(n > 0, F.transform(as_double(v), lambda x: x / n))
