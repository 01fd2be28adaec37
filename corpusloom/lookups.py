"""Small per-class tables brought to every row, with their size checked.

A broadcast join would do the same, but nothing in a plan proves that an aggregate stays small.
Here the table is cut one row above its bound before it is gathered, the bound is tested, and the
result reaches the rows as a scalar subquery: the big side is neither shuffled nor joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ENTRIES = 1000


def gathered(frame: DataFrame, entry: Column, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """One row with all ``entries`` of a small frame; an error when there are too many."""
    rows = frame.limit(max_entries + 1).agg(F.collect_list(entry).alias("entries"))
    checked = F.when(F.size("entries") <= max_entries, F.col("entries")).otherwise(
        F.raise_error(F.lit(f"lookup table has more than {max_entries} rows"))
    )
    return rows.select(checked.alias("entries"))


def bounded_list(frame: DataFrame, entry: Column, max_entries: int = MAX_ENTRIES) -> Column:
    """All rows of a small ``frame`` as one array."""
    return gathered(frame, entry, max_entries).scalar()


def bounded_map(frame: DataFrame, key: str, value: Column, max_entries: int = MAX_ENTRIES) -> Column:
    """``key -> value`` of a small ``frame`` whose keys are unique and not null."""
    entries = gathered(frame, F.struct(F.col(key), value.alias("v")), max_entries)
    return entries.select(F.map_from_entries("entries").alias("m")).scalar()


def one_row(frame: DataFrame) -> Column:
    """The single row of an ungrouped aggregate, as a struct column."""
    return frame.select(F.struct("*").alias("row")).scalar()


def literal_map(pairs: dict[str, object]) -> Column:
    """A map literal from a Python dict."""
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
