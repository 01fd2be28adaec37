"""Exact stratified splits, folds and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as w

from corpusloom.operators.ordering import with_passed_cuts


def stratified_split(
    df: DataFrame, label: str, key: str, percents: dict[str, int], seed: int = 42, name: str = "split"
) -> DataFrame:
    """Add the split a row belongs to, e.g. ``{"train": 80, "val": 10, "test": 10}``.

    Sizes are exact per label, to within rounding. ``key`` is unique. Rows are compared with the
    few cut keys of their label; the wide rows are neither sorted nor shuffled.
    """
    if sum(percents.values()) != 100:
        raise ValueError("percents must add up to 100")
    names = list(percents)
    upto = [sum(percents[n] for n in names[: i + 1]) for i in range(len(names) - 1)]
    cuts = [F.floor((F.col("n") * p + 50) / 100) for p in upto]
    passed = with_passed_cuts(df, label, key, cuts, seed, "_passed")
    return passed.withColumn(name, F.get(F.array(*[F.lit(n) for n in names]), F.col("_passed"))).drop("_passed")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Add a fold number 0..k-1; the folds of one label differ by at most one row."""
    cuts = [F.floor(F.col("n") * j / k) for j in range(1, k)]
    return with_passed_cuts(df, label, key, cuts, seed, name)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with weight = rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    every = w.Window.partitionBy()
    return counts.withColumn("weight", F.sum("n").over(every) / (F.count("*").over(every) * F.col("n")))


def with_weights(df: DataFrame, label: str, power: int = 1, name: str = "weight") -> DataFrame:
    """Add the balanced weight of the row's class; ``power=2`` applies the balance twice.

    Null is a class like any other.
    """
    weights = class_weights(df, label).select(F.col(label).alias("_class"), F.pow("weight", F.lit(power)).alias(name))
    held = df.drop(name)
    return held.join(weights, F.col(label).eqNullSafe(F.col("_class")), "left").drop("_class")


def label_codes(label: Column, codes: dict[str, int]) -> Column:
    """The code of a label, null for a label that is not listed."""
    pairs = [F.when(label == name, code) for name, code in codes.items()]
    return F.coalesce(*pairs)
