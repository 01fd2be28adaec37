"""Small helpers for higher-order array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def positions(array: Column) -> Column:
    """0 .. size-1, empty for an empty array."""
    return F.transform(array, lambda _, i: i)


def count_if(array: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(array, test))


def total(array: Column, zero: Column | None = None) -> Column:
    return F.aggregate(array, F.lit(0) if zero is None else zero, lambda a, x: a + x)


def explode_rows(frame: DataFrame, keys: list[str], array: Column, name: str, position: str | None = None) -> DataFrame:
    """One row per array element, none for an empty array.

    The inner explode would put filters on the array below its projection and so compute an
    expensive array three times; the outer one with a filter on its output computes it once.
    """
    if position is None:
        rows = frame.select(*keys, F.explode_outer(array).alias(name))
        return rows.where(F.col(name).isNotNull())
    rows = frame.select(*keys, F.posexplode_outer(array).alias(position, name))
    return rows.where(F.col(position).isNotNull())
