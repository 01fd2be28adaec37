"""Whitening of embeddings with components from spectral divide and conquer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import named, small_batches
from corpusloom.llm.qdwh import leading_components
from corpusloom.session import materialise

MAX_DIMS = 4096
#: Entries are below this in size, so that whole numbers and their differences are exact.
LARGEST = 2.0**40


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int, offset: int) -> DataFrame:
    """``id, x``: every vector without null or non-finite entries as whole numbers floor(scale * c) + offset."""
    doubles = rows.select(named(id_col).alias("id"), named(vector_col).cast("array<double>").alias("v"))
    fine = F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform("v", lambda c: F.floor(c * scale).cast("long") + offset)
    checked = F.when(F.forall("v", lambda c: F.abs(c) * scale < LARGEST), whole).otherwise(
        F.raise_error(F.lit(f"an entry of a vector is {LARGEST / scale:g} or more")))
    return doubles.where(fine).select("id", checked.alias("x"))


def matrix_of(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def dimension_sums(dims: int):
    """The sums of a task by dimension; they are whole numbers and exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, np.int64)
        for batch in batches:
            total += matrix_of(batch, dims).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(total)], ["dim", "total"])

    return run


def centred_products(mean: np.ndarray):
    """The sums of products of centred entries of a task: a row of the matrix in each row."""
    dims = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((dims, dims))
        for batch in batches:
            centred = matrix_of(batch, dims) - mean
            products += centred.T @ centred
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(list(products))], ["dim", "products"])

    return run


def exact_deviation(rows: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """The sum of (n x - S)^2 over the dimensions in whole numbers; null where it has more than 63 bits."""
    rough = ((n * rows.astype(float) - sums) ** 2).sum(1)
    exact = ((n * rows - sums) ** 2).sum(1).tolist()
    for i in np.flatnonzero(rough >= 2.0**62):
        total = sum((n * x - s) ** 2 for x, s in zip(rows[i].tolist(), sums.tolist()))
        exact[i] = total if total < 2**63 else None
    return pa.array(exact, pa.int64())


def projected(n: int, sums: np.ndarray, weights: np.ndarray):
    """Rows ``id, x`` to ``id, deviation, whitened``; ``weights`` has a column for each component."""
    dims, mean = len(sums), sums / n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix_of(batch, dims)
            white = (rows - mean) @ weights
            lists = pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), weights.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), exact_deviation(rows, n, sums), lists], ["id", "deviation", "whitened"])

    return run


def identity_error(rows: DataFrame, count: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` minus the identity, over all rows."""
    at = [F.col("whitened")[i] for i in range(count)]
    means = rows.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(at)]).first()
    centred = [c - F.lit(means[i]) for i, c in enumerate(at)]
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    entries = rows.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(entry - (i == j)) for entry, (i, j) in zip(entries, pairs))


def whitened_embeddings(
    rows: DataFrame,
    components: int = 8,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    offset: int = 100_000,
) -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error``, a row for each vector and component.

    Entries become whole numbers x = floor(scale * c) + offset. The fit uses all vectors: sums by
    dimension, then products of entries centred on the mean, both combined in each task before they
    are added up, so what meets is a matrix of dimensions squared, at most ``MAX_DIMS`` on a side. Its leading
    eigenvectors come from polar decompositions that split invariant subspaces, and the whitening
    matrix, dimensions times ``components``, goes to the tasks.

    ``whitened`` is the centred vector on a component (from 1, by falling eigenvalue) over the root of its eigenvalue,
    ``explained`` the eigenvalue's share of the trace, ``deviation`` the sum of (n x - S)^2 over dimensions, null if it
    needs more than 63 bits, and ``identity_error`` how far the covariance of all whitened rows is from the identity.

    - null vectors and vectors with null, infinite or not-a-number entries: left out, of the fit too
    - null and repeated ids: every row counts and is returned; equal vectors have equal results
    - components without variance (up to rounding), as in tables with one distinct vector: no rows for them
    - vectors of different lengths, more than ``MAX_DIMS`` dimensions, or entries of 2^40 / scale: an error
    - an empty table, or vectors without entries: an empty result; other columns are ignored
    """
    spark = rows.sparkSession
    small_batches(spark)
    kept = whole_vectors(rows, id_col, vector_col, scale, offset)
    id_type = kept.schema["id"].dataType.simpleString()
    n, dims, most = kept.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if n and dims != most:
        raise ValueError(f"vectors have {dims} to {most} dimensions")
    if n and dims > MAX_DIMS:
        raise ValueError(f"vectors have {dims} dimensions, {MAX_DIMS} is the bound")
    columns = f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not n or not dims:
        return spark.createDataFrame([], columns)
    totals = kept.select("x").mapInArrow(dimension_sums(dims), "dim long, total long").groupBy("dim").agg(F.sum("total").alias("total"))
    sums = np.array([r["total"] for r in totals.orderBy("dim").collect()], np.int64)
    parts = kept.select("x").mapInArrow(centred_products(sums / n), "dim long, products array<double>")
    entries = parts.select("dim", F.posexplode("products").alias("other", "p")).groupBy("dim", "other").agg(F.sum("p").alias("p"))
    lines = entries.groupBy("dim").agg(F.array_sort(F.collect_list(F.struct("other", "p"))).alias("line")).orderBy("dim").collect()
    covariance = np.array([[e["p"] for e in line["line"]] for line in lines]) / n
    trace = float(np.trace(covariance))
    values, vectors = leading_components(covariance, components)
    some = values > 1e-12 * trace
    values, vectors = values[some], vectors[:, some]
    if not len(values):
        return spark.createDataFrame([], columns)
    weights = vectors / np.sqrt(values)
    white = kept.mapInArrow(projected(n, sums, weights), f"id {id_type}, deviation long, whitened array<double>")
    white = materialise(white, "whitened")
    error = identity_error(white, len(values))
    shares = F.array(*[F.lit(float(v) / trace) for v in values])
    return white.select(
        F.col("id").alias(id_col), F.lit(n).cast("long").alias("n"), "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        id_col, (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
