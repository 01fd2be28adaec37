"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.llm.char_ngrams import BITS, present
from corpusloom.llm.common import id_and_text, lean, named, release, sampled
from corpusloom.session import materialise, scratch_path

LENGTHS = (3, 4, 5)


@dataclass
class ToxicityModel:
    """``weights[bucket]`` is coefficient times log-count ratio, 0 for buckets that are no feature."""

    weights: np.ndarray
    bias: float
    lengths: tuple[int, ...] = LENGTHS

    def scores(self, texts: list[str]) -> np.ndarray:
        sums = np.zeros(len(texts))
        for rows, buckets in present(texts, self.lengths, self.weights != 0):
            sums += np.bincount(rows, self.weights[buckets], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(sums + self.bias, -30, 30)))


def dense_model(buckets: np.ndarray, values: np.ndarray, bias: float) -> ToxicityModel:
    weights = np.zeros(2**BITS)
    weights[buckets] = values
    return ToxicityModel(weights, bias)


def sparse_vectors(rows: DataFrame, size: int) -> DataFrame:
    """``y`` and the sparse vector ``x`` of rows ``y, at, x``, whose places ``at`` are ascending.

    The rows are written as what a vector consists of and read back as vectors, without workers for a Python function.
    """
    parts = {"type": F.lit(0).cast("tinyint"), "size": F.lit(size), "indices": F.col("at"), "values": F.col("x")}
    path = scratch_path(rows.sparkSession, "toxic-features")
    rows.select("y", F.struct(*[c.alias(name) for name, c in parts.items()]).alias("x")).write.parquet(path)
    return rows.sparkSession.read.schema(StructType().add("y", "double").add("x", VectorUDT())).parquet(path)


def fit_toxicity(
    rows: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int = 20_000,
    max_features: int = 1 << 14,
    min_rows: int = 5,
    smoothing: float = 1.0,
    parts: int = 3,
) -> ToxicityModel:
    """Fit on about ``max_rows`` labelled rows, chosen by the hash of their id.

    Each n-gram is present or absent in a text. Its log-count ratio compares its smoothed share
    among toxic and other texts; the ``max_features`` n-grams of at least ``min_rows`` texts with
    the most significant difference become features, each scaled by its ratio, and a regularised
    logistic regression weighs them.

    A model that separates its own rows is too sure of itself, so the score of 0.5 is placed by rows the
    model has not seen: each of ``parts`` parts is scored by a model of the others, and the bias moves to
    where the toxic rows have the best F1. With a toxic or other row in too few parts it stays.

    Rows without a label are ignored. Without any label the score is 0 for every text; with one
    class only it is the share of that class, so 0 or 1; without features the share of toxic rows.
    """
    data = rows.select(
        named(id_col).alias("id"), F.coalesce(named(text_col), F.lit("")).alias("text"), named(label_col).cast("int").alias("y")
    ).where("y IS NOT NULL")
    data = sampled(data, F.col("id"), max_rows).repartition(12, "id", "text")
    data = data.withColumn("part", F.pmod(F.xxhash64("id", F.lit("part")), F.lit(parts)).cast("int"))
    fit = ToxicityFit(materialise(data, "toxic-rows"), max_features, min_rows, smoothing)
    if not fit.crossed(parts):
        return fit.model()
    margin = fit.best_margin({part: fit.weighed(part) for part in range(parts)})
    model = fit.model()
    model.bias -= margin
    return model


class ToxicityFit:
    """The labelled rows (``y, text, part``) with their n-grams counted once, and models of all rows or all but one part."""

    def __init__(self, data: DataFrame, max_features: int, min_rows: int, smoothing: float) -> None:
        self.data, self.max_features, self.min_rows, self.smoothing = data, max_features, min_rows, smoothing
        seen = data.groupBy("part", "y").agg(F.count("*").alias("n")).collect()
        self.seen = {(r["part"], r["y"]): r["n"] for r in seen}

        def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            totals: dict[tuple[int, int], np.ndarray] = {}
            for frame in lean(frames):
                for key, own in frame.groupby(["part", "y"]):
                    held = totals.setdefault(key, np.zeros(2**BITS, np.int32))
                    for _, buckets in present(own["text"].tolist(), LENGTHS):
                        held += np.bincount(buckets, minlength=2**BITS).astype(np.int32)
            for (part, y), held in totals.items():
                at = np.flatnonzero(held)
                yield pd.DataFrame({"bucket": at, "part": part, "y": y, "n": held[at]})
            release()

        found = data.select("part", "y", "text").mapInPandas(count, "bucket long, part int, y int, n long")
        self.counts = materialise(found.groupBy("bucket", "part", "y").agg(F.sum("n").alias("n")), "toxic-grams")

    def rows(self, label: int, without: int | None = None) -> int:
        """How many rows have a label; toxic ones have 1, others any other number."""
        return sum(n for (part, y), n in self.seen.items() if (y == 1) == (label == 1) and part != without)

    def crossed(self, parts: int) -> bool:
        """Whether both classes remain whichever part is left out."""
        return parts > 1 and all(self.rows(label, part) for label in (0, 1) for part in range(parts))

    def features(self, without: int | None) -> list[tuple[int, float]]:
        """Bucket and log-count ratio of the n-grams that tell toxic rows from others, in the order of buckets."""
        toxic, other, smooth = self.rows(1, without), self.rows(0, without), self.smoothing
        kept = self.counts if without is None else self.counts.where(F.col("part") != without)
        sums = [F.sum(F.when(side, F.col("n")).otherwise(0)) for side in (F.col("y") == 1, F.col("y") != 1)]
        counts = kept.groupBy("bucket").agg(sums[0].alias("p"), sums[1].alias("q")).where(F.col("p") + F.col("q") >= self.min_rows)
        a = (F.col("p") + smooth) / (toxic + 2 * smooth)
        b = (F.col("q") + smooth) / (other + 2 * smooth)
        pooled = (F.col("p") + F.col("q") + smooth) / (toxic + other + 2 * smooth)
        gain = F.abs(a - b) / F.sqrt(pooled * (1 - pooled) * (1 / toxic + 1 / other) + 1e-12)
        chosen = counts.select("bucket", F.log(a / b).alias("ratio"), gain.alias("gain"))
        best = chosen.orderBy(F.desc("gain"), "bucket").limit(self.max_features).collect()
        return sorted((f["bucket"], f["ratio"]) for f in best)

    def model(self) -> ToxicityModel:
        return dense_model(*self.weighed())

    def weighed(self, without: int | None = None) -> tuple[np.ndarray, np.ndarray, float]:
        """Buckets, their weights and the bias, fitted on all rows or on those outside one part."""
        toxic, other = self.rows(1, without), self.rows(0, without)
        none = np.empty(0, np.int64), np.empty(0)
        if not toxic or not other:
            return *none, 30.0 if toxic else -30.0
        features = self.features(without)
        if not features:
            return *none, float(np.log(toxic / other))
        buckets, scale = (np.array(x) for x in zip(*features))

        def hits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ratios, numbers = np.zeros(2**BITS), np.full(2**BITS, -1, np.int32)
            ratios[buckets], numbers[buckets] = scale, np.arange(len(buckets))
            for frame in lean(frames):
                found = list(present(frame["text"].tolist(), LENGTHS, ratios != 0)) or [(np.empty(0, int),) * 2]
                row, bucket = (np.concatenate(x) for x in zip(*found))
                cuts = np.searchsorted(row, np.arange(1, len(frame)))
                yield pd.DataFrame({
                    "y": (frame["y"] == 1).astype(float),
                    "at": np.split(numbers[bucket], cuts) if len(frame) else [],
                    "x": np.split(ratios[bucket], cuts) if len(frame) else [],
                })

        kept = self.data if without is None else self.data.where(F.col("part") != without)
        train = kept.select("y", "text").mapInPandas(hits, "y double, at array<int>, x array<double>")
        train = sparse_vectors(train, len(buckets)).persist()
        fitted = LogisticRegression(featuresCol="x", labelCol="y", regParam=1e-4, maxIter=60, standardization=False).fit(train)
        train.unpersist()
        release()
        return buckets, fitted.coefficients.toArray() * scale, float(fitted.intercept)

    def best_margin(self, models: dict[int, tuple[np.ndarray, np.ndarray, float]]) -> float:
        """The margin from which rows count as toxic with the best F1, by models that have not seen them.

        Margins are log odds in steps of a tenth; among equals the one nearest 0.
        """

        def margins(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            whole = {part: dense_model(*weighed) for part, weighed in models.items()}
            for frame in lean(frames):
                for part, own in frame.groupby("part"):
                    score = whole[part].scores(own["text"].tolist())
                    step = np.round(10 * np.log(score / (1 - score))).astype(int)
                    yield pd.DataFrame({"y": (own["y"] == 1).to_numpy(), "step": step})

        found = self.data.select("part", "y", "text").mapInPandas(margins, "y boolean, step int")
        steps = found.groupBy("step").agg(F.sum(F.col("y").cast("int")).alias("toxic"), F.count("*").alias("n")).collect()
        at = np.array(sorted(r["step"] for r in steps))
        held = {r["step"]: r for r in steps}
        hits = np.cumsum([held[s]["toxic"] for s in at[::-1]])[::-1]
        named_toxic = np.cumsum([held[s]["n"] for s in at[::-1]])[::-1]
        f1 = 2 * hits / (named_toxic + hits[0])
        return float(min(at[f1 == f1.max()], key=abs)) / 10 - 0.05


def toxic_score(spark: SparkSession, text: Column, model: ToxicityModel) -> Column:
    """The score of a string column, 0 to 1; a null or empty text gets the score of no n-gram."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in lean(parts):
            yield pd.Series(held.value.scores(part.tolist()), dtype="float64")

    return score(F.coalesce(text, F.lit("")))


def fold(ids: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(ids.cast("string"), F.lit(""))), F.lit(folds))


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 5,
    max_rows: int = 20_000,
) -> ToxicityModel:
    """A model of the labelled documents outside fold 0.

    A document with several label rows is toxic if one of them says so. The labelled ids are sampled
    before their texts are fetched; at most ``2 * max_rows`` of them are sent to the tasks.
    """
    known = labels.select(named(id_col).alias("id"), named(label_col).cast("int").alias("y")).dropna()
    known = known.where(fold(F.col("id"), folds) != 0).groupBy("id").agg(F.max("y").alias("y"))
    known = materialise(sampled(known, F.col("id"), max_rows).limit(2 * max_rows), "toxic-labels")
    train = id_and_text(docs, id_col, text_col).join(F.broadcast(known), "id")
    return fit_toxicity(train, "id", "text", "y", max_rows=2 * max_rows)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 5,
    max_rows: int = 20_000,
) -> DataFrame:
    """``id_col, held_out, score, predicted`` for every row, by a model of the labelled rows that are not held out.

    Fold 0 is held out, and so are null ids. Label, language, source and id are no inputs of a score.
    Null and empty texts get the score of no n-gram; repeated rows are scored alike and each
    returned; without any label all scores are near 0; other columns are ignored.
    """
    model = learn_toxicity(docs, labels, id_col, text_col, label_col, folds, max_rows)
    rows = id_and_text(docs, id_col, text_col)
    score = toxic_score(docs.sparkSession, F.col("text"), model)
    scored = rows.select(F.col("id").alias(id_col), (fold(F.col("id"), folds) == 0).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
