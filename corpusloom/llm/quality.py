"""Quality rules: fixed rules and an isolation forest on rule statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import id_and_text, lean, named, sampled
from corpusloom.session import materialise

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
CELLS = 1 << 16
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def word_codes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word; each distinct word is hashed once."""
    known = {w: xxhash.xxh64_intdigest(w) for w in set(words)}
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def windows(codes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash per run of ``width`` words."""
    mixed = codes[: len(codes) - width + 1].copy()
    for i in range(1, width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - width + 1 + i]
        mixed ^= mixed >> np.uint64(29)
    return mixed


def statistics(text: str) -> tuple[int, int, int, int, int]:
    """``STATISTICS`` of one text; words are runs without ASCII white space."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    chars = len(text) - sum(map(data.count, map(bytes, zip(WHITE))))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip()]
    repeated = 0
    if len(words) > WINDOW:
        _, which, counts = np.unique(windows(word_codes(words), WINDOW), return_inverse=True, return_counts=True)
        often = np.flatnonzero(counts[which] > 1)
        if len(often):
            edges = np.zeros(len(words) + 1, np.int64)
            np.add.at(edges, often, 1)
            np.add.at(edges, often + WINDOW, -1)
            repeated = int((np.cumsum(edges[:-1]) > 0).sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the columns ``STATISTICS`` (long) for every row; zeros for null and empty texts."""

    columns = ", ".join(f"{name} long" for name in STATISTICS)

    @F.pandas_udf(f"struct<{columns}>")
    def measure(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in lean(parts):
            rows = np.array([statistics(t) for t in part], np.int64).reshape(len(part), len(STATISTICS))
            yield pd.DataFrame(rows, columns=list(STATISTICS))

    rows = id_and_text(docs, id_col, text_col).select("id", measure("text").alias("s"))
    return rows.select(F.col("id").alias(id_col), "s.*")


def features(stats: pd.DataFrame) -> np.ndarray:
    words = np.maximum(stats["n_words"].to_numpy(float), 1)
    chars = np.maximum(stats["word_chars"].to_numpy(float), 1)
    return np.column_stack([
        np.log(words), chars / words, stats["n_symbols"] / chars, stats["n_dup_lines"] / words, stats["n_repeat_words"] / words,
    ])


@dataclass
class IsolationForest:
    """Trees as arrays: at a node the split column, its value and the path length if it is a leaf."""

    columns: np.ndarray
    values: np.ndarray
    lengths: np.ndarray
    depth: int
    sample: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores, 0 to 1: near 1 for rows that few random splits isolate."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for columns, values, lengths in zip(self.columns, self.values, self.lengths):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                split = columns[node]
                go = np.where(x[rows, np.maximum(split, 0)] < values[node], 1, 2)
                node = np.where(split >= 0, 2 * node + go, node)
            total += lengths[node]
        return 2.0 ** (-total / len(self.columns) / max(average_path(self.sample), 1e-9))


def average_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def separation(x: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Per column, 0 to 1: how far the ranks of the bad rows lie from those of the others (|2 AUC - 1|); ones without both classes."""
    n, m = int(bad.sum()), int((~bad).sum())
    if not n or not m:
        return np.ones(x.shape[1])
    ranks = pd.DataFrame(x).rank().to_numpy()[bad].sum(0)
    return np.abs(2 * (ranks - n * (n + 1) / 2) / (n * m) - 1)


def fit_forest(
    x: np.ndarray, trees: int = 100, sample: int = 256, seed: int = 7, weights: np.ndarray | None = None
) -> IsolationForest:
    """Splits choose among the columns that vary in proportion to ``weights``, each at least 0.001."""
    rng = np.random.default_rng(seed)
    weights = np.maximum(np.ones(x.shape[1]) if weights is None else weights, 1e-3)
    sample = min(sample, len(x))
    depth = max(1, int(np.ceil(np.log2(max(sample, 2)))))
    nodes = 2 ** (depth + 1) - 1
    columns = np.full((trees, nodes), -1)
    values, lengths = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for tree in range(trees):
        stack = [(0, 0, x[rng.choice(len(x), sample, replace=False)])]
        while stack:
            node, level, part = stack.pop()
            low, high = (part.min(0), part.max(0)) if len(part) else (np.zeros(x.shape[1]),) * 2
            wide = np.flatnonzero(high > low)
            if level == depth or not len(wide):
                lengths[tree, node] = level + average_path(len(part))
                continue
            column = rng.choice(wide, p=weights[wide] / weights[wide].sum())
            value = rng.uniform(low[column], high[column])
            columns[tree, node], values[tree, node] = column, value
            left = part[:, column] < value
            stack += [(2 * node + 1, level + 1, part[left]), (2 * node + 2, level + 1, part[~left])]
    return IsolationForest(columns, values, lengths, depth, sample)


def best_cell(cells: pd.DataFrame, false_drops: float) -> int:
    """The lowest cell to drop, from ``cell, good, bad``: best F1 of the bad rows, the highest cell among equals.

    Without bad rows, the lowest one that drops at most the share ``false_drops`` of the good ones.
    """
    cells = cells.sort_values("cell", ascending=False)
    hits, wrong = cells["bad"].cumsum().to_numpy(), cells["good"].cumsum().to_numpy()
    if not hits[-1]:
        return int(min([CELLS + 1, *cells["cell"][wrong <= false_drops * wrong[-1]]]))
    return int(cells["cell"].iloc[np.argmax(2 * hits / (hits + wrong + hits[-1]))])


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_rows: int = 20_000,
    trees: int = 100,
    sample: int = 256,
    false_drops: float = 0.002,
) -> DataFrame:
    """``id_col``, ``STATISTICS``, ``base_failed, anomaly, kept`` for every row.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated windows of eight. The
    forest is fitted on about ``max_rows`` labelled rows that pass the fixed rules, chosen by the
    hash of their id; each of its ``trees`` sees ``sample`` of them, and splits prefer the statistics
    that tell good and bad rows apart. The threshold is chosen on all labelled rows that pass the fixed
    rules, by the best F1 of the bad ones; scores count in cells of 1/65,536. If no row is labelled bad,
    at most the share ``false_drops`` of the good ones is dropped. ``kept`` is false if the fixed rules
    fail or the anomaly reaches the threshold.

    Null and empty texts have no words and fail. Without labelled good rows nothing is dropped but
    by the fixed rules. Several labels of one id: good if one of them is. Repeated rows are each
    returned; other columns are ignored.
    """
    stats = materialise(rule_statistics(docs, id_col, text_col), "rule-statistics")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    known = labels.select(named(id_col).alias("id"), named(label_col).cast("int").alias("y")).dropna()
    known = materialise(known.groupBy("id").agg(F.max("y").alias("y")), "rule-labels")
    few = sampled(known, F.col("id"), max_rows).limit(2 * max_rows)
    rows = stats.where(~failed).withColumnRenamed(id_col, "id").join(F.broadcast(few), "id").select("id", "y", *STATISTICS)
    train = rows.orderBy("id", *STATISTICS).limit(4 * max_rows).toPandas()
    good = train[train["y"] == 1]
    scored = stats.withColumn("base_failed", failed)
    if len(good) < 2:
        return scored.select("*", F.lit(0.0).alias("anomaly"), (~F.col("base_failed")).alias("kept"))
    x = features(train)
    forest = fit_forest(x, trees, sample, weights=separation(x, (train["y"] != 1).to_numpy()))
    held = docs.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def anomaly(part: pd.DataFrame) -> pd.Series:
        return pd.Series(held.value.scores(features(part)))

    scored = materialise(scored.withColumn("anomaly", anomaly(F.struct(*STATISTICS))), "rule-scores")
    cell = F.floor(F.col("anomaly") * CELLS)
    judged = scored.where(~F.col("base_failed")).select(named(id_col).alias("id"), cell.alias("cell")).join(known, "id")
    cells = judged.groupBy("cell").agg(F.count_if(F.col("y") == 1).alias("good"), F.count_if(F.col("y") != 1).alias("bad"))
    return scored.withColumn("kept", ~F.col("base_failed") & (cell < best_cell(cells.toPandas(), false_drops)))
