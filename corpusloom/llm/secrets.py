"""Secret scans: fixed patterns, and character Markov models of random strings and identifiers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import id_and_text, lean, named, small_batches

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
ORDINARY = re.compile(r"[A-Za-z_][A-Za-z0-9_-]{5,}")
CODES = np.full(128, -1)
CODES[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
N = len(ALPHABET)

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns as (start, kind, end), ordered by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def outside(start: int, end: int, spans: list[Span]) -> list[tuple[int, int]]:
    """The parts of a stretch that lie in none of the spans, which are ordered by start."""
    parts = []
    for s, _, e in spans:
        if s >= end:
            break
        if e > start:
            if s > start:
                parts.append((start, s))
            start = e
    return parts + [(start, end)] if start < end else parts


def transitions(tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character pairs of all tokens: the token each belongs to, and both codes."""
    points = np.frombuffer("\x00".join(tokens).encode("ascii"), np.uint8)
    codes, owner = CODES[points], np.cumsum(points == 0)
    inside = (codes[:-1] >= 0) & (codes[1:] >= 0)
    return owner[:-1][inside], codes[:-1][inside], codes[1:][inside]


@dataclass
class MarkovModel:
    """``ratio[a, b]``: log of how much likelier ``b`` follows ``a`` in random strings than in identifiers."""

    ratio: np.ndarray

    def scores(self, tokens: list[str]) -> np.ndarray:
        """The log-likelihood ratio of each token, summed over its character pairs."""
        owner, first, second = transitions(tokens)
        return np.bincount(owner, self.ratio[first, second], minlength=len(tokens))

    def spans(self, texts: list[str], min_ratio: float) -> list[list[Span]]:
        """All spans of each text, those of the fixed patterns included."""
        found = [base_spans(text) for text in texts]
        where, tokens = [], []
        for row, text in enumerate(texts):
            for m in CANDIDATE.finditer(text):
                for start, end in outside(m.start(), m.end(), found[row]):
                    where.append((row, start, end))
                    tokens.append(text[start:end])
        if tokens:
            for (row, start, end), score in zip(where, self.scores(tokens)):
                if score >= min_ratio:
                    found[row].append((start, 3, end))
        return [sorted(own) for own in found]


def labelled_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``token, is_random`` of all documents.

    Values in spans of the fixed patterns are labelled random, the identifiers of texts without
    such a span ordinary.
    """

    def label(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in lean(parts):
            tokens, marks = [], []
            for text in part["text"]:
                spans = base_spans(text)
                own = [re.split(r"[:=\"' ]+", text[s:e])[-1] for s, _, e in spans] or ORDINARY.findall(text)
                own = [x for x in own if x]
                tokens += own
                marks += [bool(spans)] * len(own)
            yield pd.DataFrame({"token": pd.Series(tokens, dtype=object), "is_random": pd.Series(marks, dtype=bool)})

    return id_and_text(docs, id_col, text_col).mapInPandas(label, "token string, is_random boolean")


def fit_markov(labelled: DataFrame, smoothing: float = 1.0) -> MarkovModel:
    """Transition counts of both classes, from ``token, is_random``, smoothed towards the uniform distribution.

    The counts form a table of the alphabet squared per class, whatever the number of rows. A class
    without rows is uniform. Null tokens and labels are ignored.
    """

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((2, N * N), np.int64)
        for part in lean(parts):
            for label in (0, 1):
                tokens = [t for t in part["token"][part["is_random"] == bool(label)] if t.isascii()]
                _, first, second = transitions(tokens)
                totals[label] += np.bincount(first * N + second, minlength=N * N)
        label, cell = np.nonzero(totals)
        yield pd.DataFrame({"label": label, "cell": cell, "n": totals[label, cell]})

    known = labelled.select("token", "is_random").dropna()
    cells = known.mapInPandas(count, "label int, cell int, n long").groupBy("label", "cell").agg(F.sum("n").alias("n"))
    counts = np.full((2, N * N), smoothing)
    for row in cells.collect():
        counts[row["label"], row["cell"]] += row["n"]
    counts = counts.reshape(2, N, N)
    logs = np.log(counts / counts.sum(2, keepdims=True))
    return MarkovModel(logs[1] - logs[0])


def find_secrets(
    docs: DataFrame, model: MarkovModel, id_col: str = "doc_id", text_col: str = "text", min_ratio: float = 12.0
) -> DataFrame:
    """``id_col, spans`` for every row; a span is ``kind, start, end`` in code points, end exclusive.

    The fixed patterns give the kinds assign, access and hex. Of every string of 16 or more characters of
    the alphabet, the parts outside of them (the whole string, if none meets it) that have a log-likelihood
    ratio of at least ``min_ratio`` are added as random. Spans are ordered by start, then kind. Null and empty texts have none; repeated rows are
    each returned; other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<struct<kind string, start int, end int>>")
    def scan(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in lean(parts):
            found = held.value.spans(part.tolist(), min_ratio)
            yield pd.Series([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in own] for own in found])

    rows = id_and_text(docs, id_col, text_col)
    return rows.select(F.col("id").alias(id_col), scan("text").alias("spans"))


def mask_secrets(
    docs: DataFrame, model: MarkovModel, text_col: str = "text", min_ratio: float = 12.0, mask: str = "[SECRET]"
) -> DataFrame:
    """All rows and columns of ``docs``, with every run of overlapping spans in ``text_col`` replaced.

    A null text stays null. Nothing is matched by id, so repeated and null ids do no harm.
    """
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def replace(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in lean(parts):
            texts = [t or "" for t in part]
            clean = [masked(t, own, mask) for t, own in zip(texts, held.value.spans(texts, min_ratio))]
            yield pd.Series([None if t is None else c for t, c in zip(part, clean)], dtype=object)

    return docs.withColumn(text_col, replace(named(text_col).cast("string")))


def masked(text: str, spans: list[Span], mask: str) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]
