"""Tree ensembles fitted together on distinct binned rows, and kept as tables of nodes.

Features are cut into bins once. Rows with equal bins and label are one row with a count, so a
table of small whole numbers shrinks to its distinct combinations, of which each takes some thirty
bytes. That table goes to every task, and Spark deals out the fits: one task for a boosted model of
one fold, one for a block of trees of a forest.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as w

from corpusloom.operators.metrics import binary_metrics, f1_averages
from corpusloom.session import materialise

#: Distinct rows that a joint fit may gather; more are an error.
MAX_CELLS = 4_000_000
MAX_BINS = 32
#: About so many narrow rows are binned or scored at once, whatever the batches they come in.
SCORE_ROWS = 1 << 14
#: Balanced weights are whole multiples of 1 / WEIGHT_UNIT, so that their sums do not depend on the order of rows.
WEIGHT_UNIT = 1 << 20
BLOCK_TREES = 10
TREE_COLUMNS = (
    "fit int, fold int, tree int, alpha double, feature array<tinyint>, bin array<smallint>, left array<int>, "
    "value array<double>, gain array<double>"
)


@dataclass(frozen=True)
class Ensemble:
    """What to fit: ``kind`` is ``tree``, ``forest``, ``samme`` (boosting of classes) or ``logistic`` (of a 0/1 label).

    ``balance`` is the power of the balanced class weight, taken from the rows of the fit.
    """

    kind: str
    trees: int
    depth: int
    leaf: int = 1
    rate: float = 1.0
    balance: int = 0
    seed: int = 42


def decision_tree(depth: int = 12, leaf: int = 3, balance: int = 2) -> Ensemble:
    return Ensemble("tree", 1, depth, leaf, balance=balance)


def random_forest(trees: int = 300, depth: int = 15, leaf: int = 2, balance: int = 2) -> Ensemble:
    return Ensemble("forest", trees, depth, leaf, balance=balance)


def ada_boost(rounds: int = 200, depth: int = 4, rate: float = 0.5, balance: int = 1) -> Ensemble:
    """Multi-class boosting of weighted trees (SAMME; Zhu, Zou, Rosset and Hastie 2009)."""
    return Ensemble("samme", rounds, depth, rate=rate, balance=balance)


def gradient_boosting(rounds: int = 120, depth: int = 3, rate: float = 0.08) -> Ensemble:
    """Boosting of the logistic loss with Newton steps in the leaves (Friedman 2001)."""
    return Ensemble("logistic", rounds, depth, rate=rate)


# ---- bins ----------------------------------------------------------------------------------------

def bin_edges(df: DataFrame, features: list[str], max_bins: int = MAX_BINS) -> list[list[float]]:
    """The upper edges of the bins of every feature but the last bin's, rising.

    Up to ``max_bins`` values have a bin each; more values are cut at equal counts of rows.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("v")) for i, c in enumerate(features)])
    counts = df.select(F.inline(pairs)).groupBy("f", "v").agg(F.count("*").alias("n"))
    by, upto = w.Window.partitionBy("f"), w.Window.partitionBy("f").orderBy("v")
    placed = counts.select(
        "f", "v", F.row_number().over(upto).alias("i"), F.count("*").over(by).alias("values"), F.sum("n").over(by).alias("all"),
        (F.sum("n").over(upto) - F.col("n")).alias("before"),
    )
    own = F.when(F.col("values") <= max_bins, F.col("i")).otherwise(F.floor(F.col("before") * max_bins / F.col("all")))
    edges = placed.groupBy("f", own.alias("bin")).agg(F.max("v").alias("edge")).orderBy("f", "bin").collect()
    return [[r["edge"] for r in edges if r["f"] == i][:-1] for i in range(len(features))]


def placed(columns: list[pa.Array], edges: list[list[float]]) -> np.ndarray:
    """The bin of every value, from 0: how many edges it exceeds. Null and not-a-number exceed all."""
    found = np.empty((len(columns[0]), len(edges)), bin_type(edges))
    for i, (c, own) in enumerate(zip(columns, edges)):
        found[:, i] = np.searchsorted(own, c.to_numpy(zero_copy_only=False))
    return found


def bin_type(edges: list[list[float]]) -> np.dtype:
    """The type of stored bins."""
    return np.dtype(np.uint8 if max(map(len, edges)) < 256 else np.int32)


def gathered(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[list[pa.Array]]:
    """Batches of columns put together to about ``SCORE_ROWS`` rows; a batch may hold few, since texts are long."""
    held, rows = [], 0
    for columns in parts:
        held.append((columns,) if isinstance(columns, pa.Array) else columns)
        rows += len(held[-1][0])
        if rows >= SCORE_ROWS:
            yield [pa.concat_arrays(own) for own in zip(*held)]
            held, rows = [], 0
    if held:
        yield [pa.concat_arrays(own) for own in zip(*held)]


def packed(x: np.ndarray) -> pa.Array:
    """Every row of bins as bytes."""
    ends = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x))])


def unpacked(rows: pa.Array, edges: list[list[float]]) -> np.ndarray:
    """The bins of packed rows."""
    kind = bin_type(edges)
    if not len(rows):
        return np.empty((0, len(edges)), kind)
    _, ends, data = rows.buffers()
    ends = np.frombuffer(ends, np.int32)[rows.offset : rows.offset + len(rows) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(kind).reshape(len(rows), len(edges))


def bins(features: list[str], edges: list[list[float]]) -> Column:
    """The bins of a row as a struct ``b0, b1, ...``."""
    names = [f"b{i}" for i in range(len(features))]

    @F.arrow_udf(f"struct<{', '.join(f'{name}: int' for name in names)}>")
    def place(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in gathered(parts):
            yield pa.StructArray.from_arrays([pa.array(b.astype(np.int32)) for b in placed(columns, edges).T], names=names)

    return place(*[F.col(c).cast("double") for c in features])


def packed_bins(features: list[str], edges: list[list[float]]) -> Column:
    """The bins of a row as bytes, one for each feature, or four where there are more than 256 bins."""

    @F.arrow_udf("binary")
    def place(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in gathered(parts):
            yield packed(placed(columns, edges))

    return place(*[F.col(c).cast("double") for c in features])


def cells(df: DataFrame, features: list[str], edges: list[list[float]], by: list[Column]) -> DataFrame:
    """Distinct combinations of ``by`` and packed ``bins`` with their number of rows ``n``, written once.

    They are written in as many parts as there are cores, for a small table that is heavy to score.
    """
    binned = df.select(*by, packed_bins(features, edges).alias("bins"))
    found = binned.groupBy(*binned.columns).agg(F.count("*").alias("n"))
    return materialise(found.repartition(df.sparkSession.sparkContext.defaultParallelism), "cells")


# ---- one tree ------------------------------------------------------------------------------------

@dataclass
class Tree:
    """Nodes in arrays; ``feature`` is -1 in a leaf, the right child is ``left + 1``."""

    feature: list = field(default_factory=list)
    bin: list = field(default_factory=list)
    left: list = field(default_factory=list)
    value: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    alpha: float = 1.0


def quality(sums: list[np.ndarray], weight: np.ndarray) -> np.ndarray:
    """Sum of squares over weight, summed in a fixed order; greater is purer."""
    squares = sums[0] * sums[0]
    for s in sums[1:]:
        squares = squares + s * s
    return np.divide(squares, weight, out=np.zeros_like(squares), where=weight > 0)


def grow(bins: np.ndarray, target: np.ndarray, weight: np.ndarray, n: np.ndarray, spec: Ensemble, classes: int = 0, random=None) -> tuple[Tree, np.ndarray]:
    """A tree grown level by level from histograms, and the leaf of every row.

    ``target`` is the number of the class, or, without ``classes``, the weighted target of a regression. Of equal splits
    the first feature and bin is taken. ``random`` draws the square root of all features for each node.
    """
    width, kinds, tree = int(bins.max(initial=0)) + 1, classes or 1, Tree()
    least = np.min_scalar_type(width * kinds)
    codes = [bins[:, f].astype(least) * least.type(kinds) + (target.astype(least) if classes else least.type(0)) for f in range(bins.shape[1])]
    rows, node, leaf_of = np.arange(len(bins), dtype=np.int32), np.zeros(len(bins), np.int32), np.zeros(len(bins), np.int32)
    first, level = 0, 1  # of the nodes of this level
    # with leaves of one row only empty sides are refused, which positive weights show as well
    counting = spec.leaf > 1 or weight.min(initial=0) <= 0

    def parts(hist: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        if classes:
            sums = [hist[..., c] for c in range(classes)]
            return sums, reduce(np.add, sums)
        return [hist[..., 0]], hist[..., 1]

    def histogram(key: np.ndarray, values: list[np.ndarray], *shape: int) -> np.ndarray:
        """Sums by key, which holds the class where there are classes; without them, the sums of target and weight."""
        size = int(np.prod(shape)) * kinds
        found = [np.bincount(key, v, size).reshape(*shape, kinds) for v in values]
        return found[0] if classes else np.concatenate(found, axis=-1)

    for depth in range(spec.depth + 1):
        whole = len(rows) == len(bins)
        values = [v if whole else v[rows] for v in ((weight,) if classes else (target, weight))]
        held = n if whole else n[rows]
        kind = node.astype(np.int64) * kinds + (target if whole else target[rows]) if classes else node
        totals, counts = histogram(kind, values, level), np.bincount(node, held, level)
        base = quality(*parts(totals))
        best, split, at = base.copy(), np.full(level, -1), np.zeros(level, np.int64)
        if depth < spec.depth and width > 1:
            drawn, start = None, node.astype(np.int64) * (width * kinds)
            if random is not None:
                some = max(1, int(np.sqrt(bins.shape[1])))
                drawn = random.random((level, bins.shape[1])).argsort(1)[:, :some]
            for f in range(bins.shape[1]):
                asked = np.ones(level, bool) if drawn is None else (drawn == f).any(1)
                if not asked.any():
                    continue
                size, inside, own = int(asked.sum()), None, rows
                if drawn is not None:
                    inside = np.flatnonzero(asked[node])
                    own = rows[inside]
                    key = (np.cumsum(asked) - 1)[node[inside]] * (width * kinds)
                key = (start if inside is None else key) + (codes[f] if whole and inside is None else codes[f][own])
                pick = lambda v: v if inside is None else v[inside]  # noqa: B023, E731
                hist = histogram(key, [pick(v) for v in values], size, width)
                if counting:
                    each = np.bincount(key, pick(held), size * width * kinds).reshape(size, width, kinds).sum(2)
                else:
                    each = (parts(hist)[1] > 0).astype(float)
                left, left_n = hist.cumsum(1)[:, :-1], each.cumsum(1)[:, :-1]
                right, right_n = totals[asked][:, None] - left, each.sum(1)[:, None] - left_n
                score = quality(*parts(left)) + quality(*parts(right))
                score[(left_n < spec.leaf) | (right_n < spec.leaf)] = -1.0
                b = score.argmax(1)
                score = score[np.arange(size), b]
                better = score > best[asked]
                where = np.flatnonzero(asked)[better]
                best[where], split[where], at[where] = score[better], f, b[better]
        split[best <= base * (1 + 1e-12)] = -1
        tree.feature += split.tolist()
        tree.bin += at.tolist()
        tree.gain += np.where(split >= 0, best - base, 0.0).tolist()
        tree.value += totals.tolist()
        inner = split >= 0
        following = first + level
        tree.left += np.where(inner, following + 2 * (np.cumsum(inner) - 1), -1).tolist()
        leaf_of[rows] = first + node
        going = inner[node]
        rows, node = rows[going], node[going]
        if not len(rows):
            break
        node = (2 * (np.cumsum(inner) - 1)[node] + (bins[rows, split[node]] > at[node])).astype(np.int32)
        first, level = following, 2 * int(inner.sum())
    return tree, leaf_of


# ---- ensembles on cells --------------------------------------------------------------------------

def class_weight(labels: np.ndarray, n: np.ndarray, classes: int, power: int) -> np.ndarray:
    """Of every row, (rows / (classes * rows of its class)) ** power in whole units; 1 for power 0."""
    held = np.bincount(labels, n, classes)
    present = max(1, int((held > 0).sum()))
    weight = np.divide(n.sum(), present * held, out=np.zeros(classes), where=held > 0)
    return np.floor(reduce(np.multiply, [weight] * power, np.ones(classes)) * WEIGHT_UNIT + 0.5)[labels]


def grown(spec: Ensemble, block: int, x: np.ndarray, labels: np.ndarray, n: np.ndarray, classes: int) -> Iterator[Tree]:
    """The trees of one unit of work: a block of a forest, or a whole model of another kind."""
    weight = class_weight(labels, n, classes, spec.balance)
    if spec.kind == "tree":
        yield grow(x, labels, weight * n, n, spec, classes)[0]
    elif spec.kind == "forest":
        random = np.random.default_rng([spec.seed, block])
        for _ in range(min(BLOCK_TREES, spec.trees - block * BLOCK_TREES)):
            drawn = random.multinomial(int(n.sum()), n / n.sum())
            some = drawn > 0
            yield grow(x[some], labels[some], (weight * drawn)[some], drawn[some], spec, classes, random)[0]
    elif spec.kind == "samme":
        own, present = np.ones(len(x)), max(2, len(np.unique(labels)))
        for step in range(spec.trees):
            tree, leaf = grow(x, labels, own * weight * n, n, spec, classes)
            wrong = np.array(tree.value).argmax(1)[leaf] != labels
            error = float((own * n)[wrong].sum() / (own * n).sum())
            if error >= 1 - 1 / present:
                if not step:
                    yield tree
                return
            if error <= 0:
                yield tree
                return
            tree.alpha = spec.rate * (np.log((1 - error) / error) + np.log(present - 1))
            yield tree
            own = own * np.where(wrong, np.exp(tree.alpha), 1.0)
            own /= (own * n).sum() / n.sum()
    else:
        positive = min(max((labels * n).sum() / n.sum(), 1e-9), 1 - 1e-9)
        score = np.full(len(x), np.log(positive / (1 - positive)))
        yield Tree([-1], [0], [-1], [[float(score[0])] if len(x) else [0.0]], [0.0])
        for _ in range(spec.trees):
            chance = 1 / (1 + np.exp(-score))
            residual = (labels - chance) * n
            tree, leaf = grow(x, residual, n.astype(float), n, spec)
            top = np.bincount(leaf, residual, len(tree.left))
            below = np.bincount(leaf, chance * (1 - chance) * n, len(tree.left))
            value = np.divide(top, below, out=np.zeros_like(top), where=below > 1e-12)
            tree.value, tree.alpha = [[v] for v in value], spec.rate
            score = score + spec.rate * value[leaf]
            yield tree


class EnsembleModel:
    """A fitted ensemble: bins, labels and trees as arrays."""

    def __init__(self, spec: Ensemble, features: list[str], edges: list[list[float]], labels: list[float], trees: pd.DataFrame):
        self.spec, self.features, self.edges, self.labels = spec, features, edges, labels
        self.trees = trees.sort_values("tree").reset_index(drop=True)

    def votes(self) -> list[np.ndarray]:
        """What each node of each tree adds to the classes: its vote, its shares, or its step."""
        given = []
        for alpha, left, value in zip(self.trees["alpha"], self.trees["left"], self.trees["value"]):
            value = np.asarray(value, float).reshape(len(left), -1)
            if self.spec.kind == "forest":
                value = value / value.sum(1, keepdims=True)
            elif self.spec.kind != "logistic":
                value = np.eye(value.shape[1])[value.argmax(1)]
            given.append(alpha * value)
        return given

    def scorer(self):
        """Bins of rows to the number of the predicted class; the first one among equal scores."""
        walks = [tuple(np.asarray(column[i]) for column in (self.trees["feature"], self.trees["bin"], self.trees["left"]))
                 for i in range(len(self.trees))]
        votes, depth, logistic = self.votes(), self.spec.depth, self.spec.kind == "logistic"

        def score(x: np.ndarray) -> np.ndarray:
            total, every = 0.0, np.arange(len(x))
            for (feature, cut, left), vote in zip(walks, votes):
                at = np.zeros(len(x), np.int64)
                for _ in range(depth):
                    f = feature[at]
                    at = np.where(f < 0, at, left[at] + (x[every, f] > cut[at]))
                total = total + vote[at]
            return (total[:, 0] > 0).astype(np.int64) if logistic else np.argmax(total, axis=1)

        return score

    def predict(self, binned: DataFrame) -> DataFrame:
        """Add ``prediction``, the label, to rows with packed ``bins``."""
        score, labels, edges = self.scorer(), np.array(self.labels), self.edges

        @F.arrow_udf("double")
        def predicted(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for (rows,) in gathered(parts):
                yield pa.array(labels[score(unpacked(rows, edges))])

        return binned.withColumn("prediction", predicted("bins"))

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` to rows with the feature columns; every row is scored alone, so this runs on streams."""
        score, labels, edges = self.scorer(), np.array(self.labels), self.edges

        @F.arrow_udf("double")
        def predicted(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for columns in gathered(parts):
                yield pa.array(labels[score(placed(columns, edges))])

        return df.withColumn("prediction", predicted(*[F.col(c).cast("double") for c in self.features]))

    @property
    def featureImportances(self) -> list[float]:
        """Mean over trees, weighted by their votes, of each feature's share of the gain."""
        shares = np.zeros(len(self.features))
        for alpha, feature, gain in zip(self.trees["alpha"], self.trees["feature"], self.trees["gain"]):
            feature, gain = np.asarray(feature), np.asarray(gain, float)
            own = np.bincount(feature[feature >= 0], gain[feature >= 0], len(self.features))
            shares += alpha * own / own.sum() if own.sum() > 0 else 0.0
        return (shares / shares.sum() if shares.sum() > 0 else shares).tolist()

    def nodes(self, spark: SparkSession) -> DataFrame:
        """(tree, node, alpha, feature, bin, left, value): a row for each node; node 0 is the root, leaves have no feature."""
        rows = spark.createDataFrame(self.trees.assign(value=[
            np.asarray(v).reshape(len(n), -1).tolist() for v, n in zip(self.trees["value"], self.trees["left"])
        ])[["tree", "alpha", "feature", "bin", "left", "value"]].map(lambda v: v.tolist() if isinstance(v, np.ndarray) else v))
        zipped = F.arrays_zip("feature", "bin", "left", "value")
        name = F.element_at(F.array(*[F.lit(c) for c in self.features]), F.col("x.feature").cast("int") + 1)
        return rows.select("tree", "alpha", F.posexplode(zipped).alias("node", "x")).select(
            "tree", "node", "alpha", F.when(F.col("x.feature") >= 0, name).alias("feature"), "x.bin", "x.left", "x.value")

    def save(self, spark: SparkSession, path: str) -> None:
        meta = pd.DataFrame([vars(self.spec) | {"features": self.features, "edges": self.edges, "labels": self.labels}])
        listed = self.trees.map(lambda v: v.tolist() if isinstance(v, np.ndarray) else v)
        schema = f"{TREE_COLUMNS}".replace("tinyint", "int").replace("smallint", "int")
        spark.createDataFrame(listed[[c.split()[0] for c in schema.split(", ")]], schema).write.mode("overwrite").parquet(f"{path}/trees")
        kinds = "kind string, trees int, depth int, leaf int, rate double, balance int, seed int"
        spark.createDataFrame(meta, f"{kinds}, features array<string>, edges array<array<double>>, labels array<double>").write.mode(
            "overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "EnsembleModel":
        meta = spark.read.parquet(f"{path}/meta").first().asDict()
        features, edges, labels = (meta.pop(k) for k in ("features", "edges", "labels"))
        return EnsembleModel(Ensemble(**meta), features, edges, labels, spark.read.parquet(f"{path}/trees").toArrow().to_pandas())


# ---- joint fits ----------------------------------------------------------------------------------

@dataclass
class JointFit:
    """The models of several ensembles and folds, fitted from one table of cells."""

    specs: dict[str, Ensemble]
    features: list[str]
    edges: list[list[float]]
    labels: list[float]
    trees: DataFrame

    def model(self, name: str, fold: int = -1) -> EnsembleModel:
        """The model of that name; with folds, the one fitted on all rows but those of ``fold``."""
        at = list(self.specs).index(name)
        own = self.trees.where((F.col("fit") == at) & (F.col("fold") == fold)).toArrow().to_pandas()
        return EnsembleModel(self.specs[name], self.features, self.edges, self.labels, own)


def fit_jointly(
    rows: DataFrame,
    specs: dict[str, Ensemble],
    features: list[str],
    label: str = "label",
    fold: str | None = None,
    folds: int = 0,
    max_bins: int = MAX_BINS,
    edges: list[list[float]] | None = None,
) -> JointFit:
    """Fit all ``specs``, each once, or ``folds`` times on the rows of the other folds.

    Results equal those of fits on every single row: cells carry counts, leaf sizes and weights go by them, and
    a forest draws from the rows, not from the cells. There may be any number of rows; more than
    ``MAX_CELLS`` distinct ones are an error. A lost task is only fitted again.
    """
    spark = rows.sparkSession
    edges = edges or bin_edges(rows, features, max_bins)
    by = [F.col(label).cast("double").alias("label"), (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold")]
    table = cells(rows, features, edges, by)
    if table.count() > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} distinct rows to fit on")
    held = table.toArrow().combine_chunks()
    column = lambda name: held[name].to_numpy()
    labels = np.unique(column("label")).tolist()
    y, own_fold = np.searchsorted(labels, column("label")).astype(np.min_scalar_type(len(labels))), column("fold")
    x = np.concatenate([unpacked(part, edges) for part in held["bins"].chunks] or [np.empty((0, len(features)), np.uint8)])
    order = np.arange(len(x))  # by label, fold and bins
    for own in [*reversed(x.T), own_fold, y]:
        order = order[np.argsort(own[order], kind="stable")]
    shared = spark.sparkContext.broadcast((x[order], y[order], column("n")[order], own_fold[order], len(labels)))
    named = list(specs.values())
    blocks = {i: range(-(-s.trees // BLOCK_TREES) if s.kind == "forest" else 1) for i, s in enumerate(named)}
    units = [(i, f, b) for i, s in enumerate(named) for f in (range(folds) if fold else [-1]) for b in blocks[i]]
    units.sort(key=lambda u: named[u[0]].kind in ("forest", "tree"))  # boosting takes longest and starts first

    def fitted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, y, n, own_fold, classes = shared.value
        for at, f, block in itertools.chain.from_iterable(part[["fit", "fold", "block"]].itertuples(index=False) for part in parts):
            some = own_fold != f if f >= 0 else np.ones(len(x), bool)
            if not some.any():
                continue
            for k, tree in enumerate(grown(named[at], block, x[some], y[some], n[some], classes)):
                yield pd.DataFrame([(at, f, block * BLOCK_TREES + k, float(tree.alpha), tree.feature, tree.bin, tree.left,
                                     np.asarray(tree.value, float).ravel().tolist(), tree.gain)],
                                   columns=[c.split()[0] for c in TREE_COLUMNS.split(", ")])

    work = spark.createDataFrame([(k, *u) for k, u in enumerate(units)], "k int, fit int, fold int, block int")
    work = work.repartitionByRange(max(1, len(units)), "k")
    return JointFit(specs, features, edges, labels, materialise(work.mapInPandas(fitted, TREE_COLUMNS), "trees"))


def scored_cells(df: DataFrame, models: dict[str, EnsembleModel], label: str = "label", by: list[str] | None = None) -> DataFrame:
    """(model, by..., label, prediction, n): distinct rows scored by every model, with the number of rows they stand for.

    The models share their bins, as those of one joint fit do.
    """
    first = next(iter(models.values()))
    own = [F.col(c) for c in by or []]
    table = cells(df, first.features, first.edges, [*own, F.col(label).cast("double").alias("label")])
    scored = [m.predict(table).select(F.lit(name).alias("model"), *(by or []), "label", "prediction", "n") for name, m in models.items()]
    return reduce(DataFrame.unionByName, scored)


def cross_validated(
    df: DataFrame, specs: dict[str, Ensemble], features: list[str], fold: str = "fold", folds: int = 5, positive: float | None = None,
    fit_rows: DataFrame | None = None, max_bins: int = MAX_BINS,
) -> DataFrame:
    """(model, fold, score): macro F1, or F1 of ``positive``, of every fold, fitted on the others.

    All models of all folds are fitted together. ``fit_rows`` bounds the rows of the fits; every row of ``df`` is scored.
    """
    fitted = fit_jointly(fit_rows if fit_rows is not None else df, specs, features, fold=fold, folds=folds, max_bins=max_bins)
    table = cells(df, features, fitted.edges, [F.col(fold).cast("int").alias("fold"), F.col("label").cast("double").alias("label")])
    scored = []
    for name in specs:
        for f in range(folds):
            model = fitted.model(name, f)
            if len(model.trees):
                scored.append(model.predict(table.where(F.col("fold") == f)).select(F.lit(name).alias("model"), "fold", "label", "prediction", "n"))
    rows, by = materialise(reduce(DataFrame.unionByName, scored), "fold-scores"), ["model", "fold"]
    if positive is None:
        return f1_averages(rows, "label", "prediction", by, count="n").select(*by, F.col("f1_macro").alias("score"))
    return binary_metrics(rows, "label", "prediction", positive, by, count="n").select(*by, F.col("f1").alias("score"))
