"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import small_batches

M_MMAP_THRESHOLD = -3


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def named(name: str) -> Column:
    """A column by its literal name, dots and blanks included."""
    return F.col(f"`{name}`")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` and ``text`` (null: empty), and nothing else, so other columns cannot clash."""
    small_batches(docs.sparkSession)
    return docs.select(named(id_col).alias("id"), F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"))


def sampled(rows: DataFrame, key: Column, limit: int) -> DataFrame:
    """About ``limit`` rows, all when there are fewer, chosen by the hash of ``key``.

    The choice depends on the keys alone, so it is the same in every run and for every partitioning.
    """
    total = rows.count()
    if total <= limit:
        return rows
    share = int(limit / total * 2**32)
    return rows.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(2**32)) < share)


@functools.cache
def c_library() -> ctypes.CDLL | None:
    """The C library of this process if it is glibc, told to give large arrays back to the system when freed."""
    library = ctypes.CDLL(None)
    if not hasattr(library, "malloc_trim"):
        return None
    library.mallopt(M_MMAP_THRESHOLD, 1 << 18)
    return library


def release() -> None:
    """Give memory that this process no longer uses back to the system."""
    pa.default_memory_pool().release_unused()
    if library := c_library():
        library.malloc_trim(0)


def lean(parts: Iterator) -> Iterator:
    """The batches of a task; large arrays go back to the system when freed, the rest when the batches are done.

    A Python worker outlives its tasks and would otherwise keep the most memory it ever had.
    """
    c_library()
    yield from parts
    release()
