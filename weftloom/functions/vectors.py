"""Scalar similarity and hashing expressions over array and bit columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

VARIANCE_FLOOR = 1e-12


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def total(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def l2_norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(vector: Column) -> Column:
    """Unit vector; a zero vector stays zero."""
    floor = F.greatest(l2_norm(vector), F.lit(1e-12))
    # the divisor is wrapped in a one-element array so that it is evaluated once per row
    return F.flatten(F.transform(F.array(floor), lambda n: F.transform(vector, lambda x: x / n)))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.greatest(l2_norm(a), F.lit(1e-12)) * F.greatest(l2_norm(b), F.lit(1e-12)))


def squared_deviation(vector: Column) -> Column:
    """Sum of squared deviations from the mean."""
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x) - total(vector) * total(vector) / F.size(vector)


def is_flat(vector: Column) -> Column:
    """True when the vector has no variance, as an unreadable image's zero histogram."""
    return squared_deviation(vector) <= VARIANCE_FLOOR


def pearson(a: Column, b: Column) -> Column:
    """Histogram correlation; by rule it is 1 as soon as one side has no variance."""
    covariance = dot(a, b) - total(a) * total(b) / F.size(a)
    return F.when(is_flat(a) | is_flat(b), F.lit(1.0)).otherwise(
        covariance / F.sqrt(squared_deviation(a) * squared_deviation(b))
    )


def median_bits(vector: Column) -> Column:
    """64 values to a BIGINT: bit i is set when element i exceeds the median of the 64."""
    ordered = F.array_sort(vector)
    median = (F.get(ordered, F.lit(31)) + F.get(ordered, F.lit(32))) / 2

    def pack(m: Column) -> Column:
        return F.aggregate(
            vector,
            F.lit(0).cast("long"),
            lambda acc, x: F.shiftleft(acc, 1).bitwiseOR((x > m).cast("long")),
        )

    return F.get(F.transform(F.array(median), pack), F.lit(0))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
