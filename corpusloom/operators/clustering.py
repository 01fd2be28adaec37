"""Standardising, clustering and its evaluation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.arrays import let
from corpusloom.lookups import bounded_list, one_row
from corpusloom.operators.metrics import adjusted_rand_index


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean 0 and population deviation 1 for every column; a constant column is only centred.

    All moments come from one aggregate and reach the rows as one scalar subquery.
    """
    moments = [F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)] + [
        F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)
    ]
    held = df.withColumn("_m", one_row(df.agg(*moments)))
    scaled = {}
    for i, c in enumerate(columns):
        scale = F.col(f"_m.s{i}")
        scaled[c] = (F.col(c) - F.col(f"_m.m{i}")) / F.when(scale > 0, scale).otherwise(1.0)
    return held.withColumns(scaled).drop("_m")


def assemble(df: DataFrame, columns: list[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=name).transform(df)


def vectors(df: DataFrame, array: str, name: str = "features") -> DataFrame:
    """A vector column from an array column."""
    return df.withColumn(name, array_to_vector(F.transform(array, lambda x: x.cast("double"))))


def kmeans(df: DataFrame, k: int, starts: int = 10, seed: int = 42, features: str = "features", max_iter: int = 100):
    """The k-means model with the least cost over ``starts`` seeds."""
    models = [
        KMeans(k=k, seed=seed + i, maxIter=max_iter, tol=1e-4, featuresCol=features, predictionCol="cluster").fit(df)
        for i in range(starts)
    ]
    return min(models, key=lambda m: m.summary.trainingCost)


def hierarchical(df: DataFrame, k: int = 2, seed: int = 42, features: str = "features", starts: int = 3):
    """Divisive clustering by repeated bisection, the least cost over ``starts`` seeds.

    A bisection may leave one side empty and stop early; another seed then does better.
    """
    models = [
        BisectingKMeans(k=k, seed=seed + i, featuresCol=features, predictionCol="cluster").fit(df) for i in range(starts)
    ]
    return min(models, key=lambda m: m.summary.trainingCost)


def pca(df: DataFrame, k: int = 2, features: str = "features") -> DataFrame:
    """Add the coordinates ``pc1, pc2, ...`` on the first principal components."""
    projected = PCA(k=k, inputCol=features, outputCol="_pca").fit(df).transform(df)
    values = vector_to_array("_pca")
    return projected.withColumns({f"pc{i + 1}": values[i] for i in range(k)}).drop("_pca")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def silhouette_rows(df: DataFrame, array: str, cluster: str, max_clusters: int = 1000) -> DataFrame:
    """Add the squared-Euclidean silhouette of every row, without forming any pair of rows.

    The mean squared distance from x to a cluster is |x|^2 - 2 x.m + q, where m is the mean of the
    cluster and q the mean squared norm; one row per cluster is all that the rows need.
    """
    point = F.transform(F.col(array), lambda v: v.cast("double"))
    pointed = df.withColumn("_x", point).withColumn("_q", _dot(F.col("_x"), F.col("_x")))
    sums = pointed.select(cluster, F.posexplode("_x").alias("d", "v")).groupBy(cluster, "d").agg(
        F.avg("v").alias("m"), F.count("*").alias("n")
    )
    means = sums.groupBy(cluster).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("d", "m"))), lambda e: e["m"]).alias("m"), F.max("n").alias("n")
    )
    norms = pointed.groupBy(cluster).agg(F.avg("_q").alias("q"))
    stats = means.join(norms, cluster).select(F.struct(F.col(cluster).alias("c"), "n", "m", "q").alias("s"))
    held = pointed.withColumn("_stats", bounded_list(stats, F.col("s"), max_clusters))
    far = F.transform(
        "_stats",
        lambda s: F.struct(
            s["c"].alias("c"), s["n"].alias("n"), (F.col("_q") - 2 * _dot(F.col("_x"), s["m"]) + s["q"]).alias("d")
        ),
    )
    own = lambda fs: F.get(F.filter(fs, lambda f: f["c"] == F.col(cluster)), F.lit(0))
    others = lambda fs: F.array_min(
        F.transform(F.filter(fs, lambda f: f["c"] != F.col(cluster)), lambda f: f["d"])
    )

    def score(fs: Column) -> Column:
        inner = own(fs)["d"] * own(fs)["n"] / F.nullif(own(fs)["n"] - 1, F.lit(0))
        return let(
            F.struct(inner.alias("a"), others(fs).alias("b")),
            lambda p: F.coalesce(F.try_divide(p["b"] - p["a"], F.greatest(p["a"], p["b"])), F.lit(0.0)),
        )

    return held.withColumn("silhouette", let(far, score)).drop("_x", "_q", "_stats")


def silhouette(df: DataFrame, array: str, cluster: str) -> DataFrame:
    """Mean squared-Euclidean silhouette."""
    return silhouette_rows(df, array, cluster).agg(F.avg("silhouette").alias("silhouette"))


def euclidean_silhouette_rows(
    df: DataFrame, key: str, array: str, cluster: str, references: int = 256, max_values: int = 4_000_000
) -> DataFrame:
    """Add the plain Euclidean silhouette of every row and its ``margin``, without forming all pairs.

    Mean distances are taken to ``references`` rows of each cluster, those with the smallest md5 of the unique ``key``;
    a row is no reference of itself. ``margin`` is two standard errors of both mean distances, carried over
    to the silhouette; where all rows of the clusters are references the value is exact and the margin 0.
    The reference rows go to every task, so they may hold ``max_values`` numbers at most; more raise an error.

    A row alone in its cluster has silhouette 0, and so has every row if there is one cluster only. Rows without a
    vector, cluster or key get null; other columns stay.
    """
    whole = F.col(key).isNotNull() & F.col(array).isNotNull() & F.col(cluster).isNotNull()
    named_rows = df.where(whole).select(
        F.col(key).cast("string").alias("key"), F.col(cluster).cast("string").alias("cluster"),
        F.transform(array, lambda v: v.cast("double")).alias("x"),
    )
    sizes = named_rows.groupBy("cluster").agg(F.count("*").alias("n"), F.max(F.size("x")).alias("dims"))
    sized = sizes.limit(max_values // references + 1).collect()
    if sum(min(references, r["n"]) * r["dims"] for r in sized) > max_values:
        raise ValueError(f"{len(sized)} clusters have more than {max_values} numbers in {references} reference rows each")
    chosen = Window.partitionBy("cluster").orderBy(F.md5("key"), "key")
    held = named_rows.withColumn("place", F.row_number().over(chosen)).where(F.col("place") <= references).toPandas()
    known = df.sparkSession.sparkContext.broadcast([
        (r["cluster"], r["n"], own["key"].to_numpy(), np.stack(own["x"].to_numpy()))
        for r in sized for own in [held[held["cluster"] == r["cluster"]]]
    ])

    @F.pandas_udf("struct<silhouette double, margin double>")
    def score(keys: pd.Series, clusters: pd.Series, points: pd.Series) -> pd.DataFrame:
        out = np.full((len(keys), 2), np.nan)
        at = np.flatnonzero(keys.notna() & clusters.notna() & points.notna())
        if len(at):
            out[at] = _silhouettes(keys.to_numpy()[at], clusters.to_numpy()[at], np.stack(points.to_numpy()[at]), known.value)
        return pd.DataFrame(out, columns=["silhouette", "margin"]).astype(object).where(~np.isnan(out), None)

    point = F.transform(array, lambda v: v.cast("double"))
    scored = df.withColumn("_s", score(F.col(key).cast("string"), F.col(cluster).cast("string"), point))
    return scored.withColumns({c: F.col(f"_s.{c}") for c in ("silhouette", "margin")}).drop("_s")


def _silhouettes(keys: np.ndarray, clusters: np.ndarray, points: np.ndarray, known: list) -> np.ndarray:
    """Silhouette and margin of a batch against the reference rows ``(cluster, size, keys, points)``."""
    own, other = np.full((2, len(keys)), np.nan), np.full((2, len(keys)), np.nan)
    for name, size, named_rows, rows in known:
        centre = rows.mean(axis=0)
        x, y = points - centre, rows - centre
        squares = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * x @ y.T
        far = np.sqrt(np.maximum(squares, 0))
        mine = clusters == name
        far[keys[:, None] == named_rows] = np.nan
        seen = (~np.isnan(far)).sum(axis=1)
        least = np.maximum(seen, 1)
        mean = np.nansum(far, axis=1) / least
        spread = np.nansum((far - mean[:, None]) ** 2, axis=1) / np.maximum(seen - 1, 1)
        left = 1 - seen / np.maximum(size - mine, 1)
        found = np.stack([mean, 2 * np.sqrt(spread * np.maximum(left, 0) / least)])
        own[:, mine & (seen > 0)] = found[:, mine & (seen > 0)]
        nearer = ~mine & ~(found[0] >= other[0])
        other[:, nearer] = found[:, nearer]
    most = np.maximum(own[0], other[0])
    result = np.stack([other[0] - own[0], own[1] + other[1]], axis=1) / np.where(most > 0, most, 1)[:, None]
    return np.nan_to_num(result)


def elbow(df: DataFrame, ks: range = range(2, 8), starts: int = 10, seed: int = 42, features: str = "features") -> DataFrame:
    """(k, inertia, silhouette) for every k."""
    rows = None
    for k in ks:
        model = kmeans(df, k, starts, seed, features)
        labelled = model.transform(df).withColumn("_v", vector_to_array(features))
        row = silhouette(labelled, "_v", "cluster").select(
            F.lit(k).alias("k"), F.lit(float(model.summary.trainingCost)).alias("inertia"), "silhouette"
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


def cluster_labels(df: DataFrame, keys: list[str], k: int = 2, starts: int = 10, seed: int = 42) -> DataFrame:
    """Keys and features with the labels of both clusterings."""
    flat = kmeans(df, k, starts, seed).transform(df).withColumnRenamed("cluster", "kmeans_cluster")
    both = hierarchical(df, k, seed).transform(flat).withColumnRenamed("cluster", "hierarchical_cluster")
    return both.select(*keys, "features", "kmeans_cluster", "hierarchical_cluster")


def clustering_summary(labelled: DataFrame, truth: str, elbow_rows: DataFrame | None = None) -> DataFrame:
    """(method, silhouette, ari) of both clusterings and, with an elbow table, the best k."""
    held = labelled.withColumn("_v", vector_to_array("features"))
    parts = []
    for method, column in (("kmeans", "kmeans_cluster"), ("hierarchical", "hierarchical_cluster")):
        ari = adjusted_rand_index(labelled, truth, column).scalar()
        parts.append(
            silhouette(held, "_v", column).select(
                F.lit(method).alias("method"), "silhouette", ari.alias("ari"), F.lit(None).cast("int").alias("best_k")
            )
        )
    if elbow_rows is not None:
        best = elbow_rows.agg(F.max_by(F.struct("k", "silhouette"), F.struct(F.col("silhouette"), -F.col("k"))).alias("b"))
        parts.append(
            best.select(
                F.lit("best_k_by_silhouette").alias("method"), F.col("b.silhouette").alias("silhouette"),
                F.lit(None).cast("double").alias("ari"), F.col("b.k").alias("best_k"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
