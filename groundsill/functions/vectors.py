"""Vector columns over arrays of numbers. Sums run in element order, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundsill.functions import bind


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(as_double(left), as_double(right), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    squares = F.transform(as_double(vector), lambda x: x * x)
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def normalize(vector: Column) -> Column:
    """Unit vector, or null where the norm is zero or not finite or the vector is missing."""

    def scaled(length: Column) -> Column:
        # NaN counts as larger than any number.
        return F.when((length > 0) & (length < float("inf")), F.transform(as_double(vector), lambda x: x / length))

    return bind(norm(vector), scaled)


def vector_error(vector: Column, dimension: int) -> Column:
    """Why a vector cannot be searched, or null."""
    length = norm(vector)
    return (
        F.when(vector.isNull(), "VECTOR_MISSING")
        .when(F.size(vector) != dimension, "DIMENSION_MISMATCH")
        .when(F.exists(vector, lambda x: x.isNull() | F.isnan(x)), "VECTOR_NOT_FINITE")
        .when(F.isnan(length) | (length == float("inf")), "VECTOR_NOT_FINITE")
        .when(length == 0, "ZERO_NORM")
    )
