"""Evaluation of labels against predictions, from counts of label pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.numeric import ratio


def _rows(count: str | None, test: Column | None = None) -> Column:
    """How many rows there are, or pass ``test``; with ``count``, a row stands for that many."""
    if count is None:
        return F.count("*") if test is None else F.count_if(test)
    n = F.col(count) if test is None else F.when(test, F.col(count)).otherwise(0)
    return F.coalesce(F.sum(n), F.lit(0))


def pair_counts(df: DataFrame, label: str, prediction: str, by: list[str] | None = None, count: str | None = None) -> DataFrame:
    """(by..., label, prediction, n): all metrics below need no more than this small table.

    With ``count``, a row stands for as many as that column says.
    """
    return df.groupBy(*(by or []), F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        _rows(count).alias("n")
    )


def binary_metrics(
    df: DataFrame, label: str, prediction: str, positive=1, by: list[str] | None = None, count: str | None = None
) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class; 0 where a denominator is 0."""
    y, p = F.col(label) == positive, F.col(prediction) == positive
    tp, fp, fn = _rows(count, y & p), _rows(count, ~y & p), _rows(count, y & ~p)
    right = _rows(count, F.col(label) == F.col(prediction))
    return df.groupBy(*(by or [])).agg(
        ratio(right, _rows(count)).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_report(
    df: DataFrame, label: str, prediction: str, by: list[str] | None = None, count: str | None = None
) -> DataFrame:
    """Precision, recall, F1 and support of every class that occurs as label or prediction."""
    by = by or []
    pairs = pair_counts(df, label, prediction, by, count)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hits")),
    )
    totals = pairs.select(*by, F.inline(sides)).groupBy(*by, "class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    return totals.select(
        *by,
        "class",
        ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )


def f1_averages(
    df: DataFrame, label: str, prediction: str, by: list[str] | None = None, count: str | None = None
) -> DataFrame:
    """Accuracy, macro F1 and support-weighted F1."""
    by = by or []
    report = class_report(df, label, prediction, by, count)
    weighted = ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support"))
    right = ratio(F.sum(F.col("recall") * F.col("support")), F.sum("support"))
    return report.groupBy(*by).agg(
        right.alias("accuracy"), F.avg("f1").alias("f1_macro"), weighted.alias("f1_weighted")
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: list) -> DataFrame:
    """Rows are labels, columns are predictions in the given order, 0 where there is none."""
    return df.groupBy(label).pivot(prediction, classes).count().fillna(0)


def _pairs_of(n: Column) -> Column:
    return n.cast("double") * (n - 1) / 2


def adjusted_rand_index(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labellings, from their contingency table; 1 for equal trivial ones."""
    cells = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))
    rows = cells.groupBy("a").agg(F.sum("n").alias("n")).agg(F.sum(_pairs_of(F.col("n"))).alias("x"))
    cols = cells.groupBy("b").agg(F.sum("n").alias("n")).agg(F.sum(_pairs_of(F.col("n"))).alias("x"))
    both = cells.agg(F.sum(_pairs_of(F.col("n"))).alias("both"), _pairs_of(F.sum("n")).alias("all"))
    sums = both.withColumn("rows", rows.scalar()).withColumn("cols", cols.scalar())
    expected = F.try_divide(F.col("rows") * F.col("cols"), F.col("all"))
    best = (F.col("rows") + F.col("cols")) / 2
    index = F.try_divide(F.col("both") - expected, best - expected)
    return sums.select(F.coalesce(index, F.lit(1.0)).alias("ari"))
