"""Vector text form, size contract and distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_to_text(vector: Column) -> Column:
    return F.to_json(vector)


def check_dim(vector: Column, dim: int) -> Column:
    """True for a vector of the right size without null or NaN; never null."""
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x))
    return F.coalesce((F.size(vector) == dim) & ~broken, F.lit(False))


def vector_from_text(text: Column, dim: int) -> Column:
    """The vector, or null when the text is no array of ``dim`` numbers."""
    vector = F.from_json(text, "array<float>")
    return F.when(check_dim(vector, dim), vector)


def l2_distance(a: Column, b: Column) -> Column:
    """Euclidean distance in double precision, for vectors already side by side in a row."""
    squares = F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))
