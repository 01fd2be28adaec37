"""Counts, distributions, pivots and summaries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as w

from corpusloom.functions.numeric import ratio


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and their share in percent."""
    rows = F.sum("n").over(w.Window.partitionBy())
    return value_counts(df, label).withColumn("percent", F.col("n") * 100.0 / rows)


def group_means(df: DataFrame, group: str, columns: list[str], digits: int = 3) -> DataFrame:
    return df.groupBy(group).agg(*[F.bround(F.avg(c), digits).alias(c) for c in columns])


def transposed(df: DataFrame, group: str, columns: list[str], values: list[str], name: str = "feature") -> DataFrame:
    """Columns as rows and the values of ``group`` as columns."""
    long = df.unpivot([group], [F.col(c).cast("double").alias(c) for c in columns], name, "value")
    return long.groupBy(name).pivot(group, values).agg(F.first("value"))


def crosstab(df: DataFrame, rows: str, column: str, values: list) -> DataFrame:
    """Counts of every pair, 0 where there is none."""
    return df.groupBy(rows).pivot(column, values).count().fillna(0)


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "nulls")


def exact_quantiles(df: DataFrame, columns: list[str], shares: list[float], parts: int = 1024) -> dict[str, list[float | None]]:
    """The quantiles of numeric columns, between two ranks in proportion, from all values but nulls and not-a-numbers.

    Each rank is looked for in a range of values that begins as the whole column. A pass cuts every range into
    ``parts`` equal ones, counts their values together with the least and greatest of each, and goes on with the one that
    holds the rank, until that is a single value. What comes back from a pass is one row for each column and rank; no
    task ever holds the distinct values of a column. Two or three passes are usual, for all columns together.
    """
    values = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("double").alias("v")) for i, c in enumerate(columns)])
    long = df.select(F.inline(values)).where(F.col("v").isNotNull() & ~F.isnan("v"))
    ends = {r["c"]: r for r in long.groupBy("c").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    wanted = {(c, k) for c, r in ends.items() for s in shares for k in (math.floor((r["n"] - 1) * s), math.ceil((r["n"] - 1) * s))}
    open_ = {(c, k): (ends[c]["lo"], ends[c]["hi"], 0) for c, k in wanted}
    found = {}
    while open_:
        found |= {at: lo for at, (lo, hi, _) in open_.items() if lo == hi}
        open_ = {at: r for at, r in open_.items() if at not in found}
        if not open_:
            break
        names = ("c", "k", "lo", "hi", "before")
        ranges = F.array(*[
            F.struct(*[F.lit(x).cast(kind).alias(name) for x, kind, name in zip((*at, *r), ("int", "long", "double", "double", "long"), names)])
            for at, r in open_.items()
        ])
        held = F.filter(ranges, lambda r: (r["c"] == F.col("c")) & F.col("v").between(r["lo"], r["hi"]))
        inside = long.select("v", F.explode(held).alias("r")).select("v", "r.*")
        half = F.col("hi") / 2 - F.col("lo") / 2
        part = F.least(F.floor((F.col("v") / 2 - F.col("lo") / 2) / half * parts), F.lit(parts - 1))
        counts = inside.groupBy("c", "k", "before", part.alias("part")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("n").over(w.Window.partitionBy("c", "k").orderBy("part").rowsBetween(w.Window.unboundedPreceding, 0))
        placed = counts.withColumn("upto", F.col("before") + upto).where((F.col("k") < F.col("upto")) & (F.col("k") >= F.col("upto") - F.col("n")))
        open_ = {(r["c"], r["k"]): (r["lo"], r["hi"], r["upto"] - r["n"]) for r in placed.collect()}

    def between(c: int, share: float) -> float | None:
        if c not in ends:
            return None
        rank = (ends[c]["n"] - 1) * share
        low, high = found[c, math.floor(rank)], found[c, math.ceil(rank)]
        return low + (high - low) * (rank - math.floor(rank))

    return {name: [between(i, s) for s in shares] for i, name in enumerate(columns)}


def summary_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, mean, std, min, q25, q50, q75, max) of numeric columns: sample deviation and exact quartiles.

    Mean and deviation come from distances to the median and do not cancel. Nulls and not-a-numbers are left out; the deviation of one value is null.
    """
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    middle = {c: F.lit(q[1]).cast("double") for c, q in quartiles.items()}
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("v"), middle[c].alias("m")) for c in columns])
    long = df.select(F.inline(values)).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    off = F.col("v") - F.col("m")
    moments = long.groupBy("column").agg(
        F.count("v").alias("n"), (F.first("m") + F.avg(off)).alias("mean"), F.when(F.count("v") > 1, F.stddev_samp(off)).alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    )
    rows = df.sparkSession.createDataFrame([(c, *q) for c, q in quartiles.items()], "column string, q25 double, q50 double, q75 double")
    return rows.join(moments, "column", "left").select("column", "n", "mean", "std", "min", "q25", "q50", "q75", "max")


def histogram(df: DataFrame, group: str, value: Column, bins: int = 30) -> DataFrame:
    """(group, bin, n): equal bins between least and greatest value of the group, the top edge closed.

    Null is a group like any other. The edges are joined, for nothing bounds the number of groups.
    """
    valued = df.select(group, value.cast("double").alias("v")).where(F.col("v").isNotNull())
    edges = valued.groupBy(F.col(group).alias("_group")).agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("e"))
    placed = valued.join(edges, F.col(group).eqNullSafe(F.col("_group")))
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    bin_no = F.when(F.col("e.hi") == F.col("e.lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("e.lo")) / F.nullif(width, F.lit(0.0))).cast("int"), F.lit(bins - 1))
    )
    return placed.select(group, bin_no.alias("bin")).groupBy(group, "bin").agg(F.count("*").alias("n"))


def wide_means(long: DataFrame, row: str, column: str, value: str, columns: list[str]) -> DataFrame:
    """Long table to wide, missing values 0, with the row mean, greatest mean first."""
    wide = long.groupBy(row).pivot(column, columns).agg(F.first(value)).fillna(0.0, columns)
    mean = sum((F.col(f"`{c}`") for c in columns), F.lit(0.0)) / len(columns)
    return wide.withColumn("mean", mean).orderBy(F.desc("mean"), row)


def top_values(long: DataFrame, groups: list[str], value: str, k: int) -> DataFrame:
    """The ``k`` most frequent values of every group; equal counts go by value.

    Counting comes first, so the ranking sees one row per group and value.
    """
    counts = long.groupBy(*groups, value).agg(F.count("*").alias("n"))
    ranked = counts.withColumn(
        "rank", F.row_number().over(w.Window.partitionBy(*groups).orderBy(F.desc("n"), value))
    )
    return ranked.where(F.col("rank") <= k)


def span_patterns(tokens: DataFrame, k: dict[str, int] | None = None) -> DataFrame:
    """Most frequent part of speech, role and lemma of the tokens that begin a span."""
    k = k or {"pos": 5, "dep": 5, "lemma": 10}
    starts = tokens.where(F.col("bio_tag").isin("B-LOC", "B-ACT"))
    long = starts.unpivot(["bio_tag"], list(k), "attribute", "value")
    top = top_values(long, ["bio_tag", "attribute"], "value", max(k.values()))
    limit = F.coalesce(*[F.when(F.col("attribute") == a, n) for a, n in k.items()])
    return top.where(F.col("rank") <= limit)


def best_of(df: DataFrame, name: str, score: str, order: str) -> DataFrame:
    """The entry with the greatest score; the first listed among equals."""
    return df.agg(F.max_by(F.struct(name, score), F.struct(F.col(score), -F.col(order))).alias("b")).select("b.*")


def fold_statistics(df: DataFrame, group: str, score: str) -> DataFrame:
    """Mean and population deviation of fold scores."""
    return df.groupBy(group).agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"))


def zipped(df: DataFrame, keys: list[str], names: Column, values: Column, name: str, value: str) -> DataFrame:
    """One row per (name, value) pair of two arrays of equal length."""
    pairs = F.arrays_zip(names.alias(name), values.alias(value))
    return df.select(*keys, F.inline(pairs).alias(name, value))


def rate(df: DataFrame, group: str, part: Column) -> DataFrame:
    """Share of rows of each group that satisfy ``part``."""
    return df.groupBy(group).agg(
        F.count("*").alias("n"), F.count_if(part).alias("hits"), ratio(F.count_if(part), F.count("*")).alias("rate")
    )
