"""Vector arithmetic on ``array<float|double>`` columns, inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Inner product; the fold runs left to right so results repeat."""
    return F.aggregate(
        F.zip_with(as_double(a), as_double(b), lambda x, y: x * y),
        F.lit(0.0),
        lambda total, item: total + item,
    )


def norm(a: Column) -> Column:
    return F.sqrt(
        F.aggregate(as_double(a), F.lit(0.0), lambda total, item: total + item * item)
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; NULL when either vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def unit(a: Column, floor: float = 1e-9) -> Column:
    """The vector at length one; the norm is floored so a zero vector stays zero."""
    length = F.greatest(norm(a), F.lit(floor))
    packed = F.struct(as_double(a).alias("v"), length.alias("n"))
    # The pair is bound once so the norm is not folded again for every element.
    return F.transform(F.array(packed), lambda p: F.transform(p["v"], lambda x: x / p["n"]))[0]
