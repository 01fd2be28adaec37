"""Scalar number functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, 0 when ``whole`` is 0 or null."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def softmax(logits: Column) -> Column:
    """Probabilities from an array of logits, shifted by the maximum so that exp cannot overflow."""
    shifted = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    return F.get(
        F.transform(F.array(shifted), lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))),
        F.lit(0),
    )


def argmax(values: Column) -> Column:
    """Zero-based position of the first maximum."""
    return F.array_position(values, F.array_max(values)) - 1
