"""A sequence tagger learnt from labelled sentences: counts of transitions and emissions, decoded by Viterbi.

Scores are logarithms in whole millionths, so sums are exact and the best path does not depend on
the order of rows or on the machine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import explode_rows
from corpusloom.session import materialise

MAX_TAGS = 1000
MILLION = 1_000_000


def word_class(word: Column) -> Column:
    """What is known of an unknown word: that it has a digit, that it has no letter, or its last two letters."""
    return (
        F.when(word.rlike(r"\p{Nd}"), "#").when(~word.rlike(r"\p{L}"), ".").otherwise(F.concat(F.lit("-"), F.right(word, F.lit(2))))
    )


def _score(n: Column, total: Column, kinds: int) -> Column:
    return F.round(F.log((n + 1) / (total + kinds)) * MILLION).cast("long")


@dataclass
class Tagger:
    """``tags`` in order; ``transitions`` by tag before (the last row is the start) and tag; scores of words and of classes."""

    tags: list[str]
    transitions: np.ndarray
    words: DataFrame
    classes: DataFrame
    unseen: list[int]


def labelled_words(messages: DataFrame, sentences: str = "sentences", token: str = "token", tag: str = "pos") -> DataFrame:
    """(before, tag, word), a row for each token; ``before`` is the tag before it, empty at the start of a sentence."""
    each = F.transform(sentences, lambda s: F.transform(s, lambda tok, i: F.struct(
        F.coalesce(F.when(i > 0, F.get(s, i - 1)[tag]), F.lit("")).alias("before"), tok[tag].alias("tag"), F.lower(tok[token]).alias("word"))))
    return explode_rows(messages, [], F.flatten(each), "w").select("w.*").where("tag IS NOT NULL AND word IS NOT NULL")


def fit_tagger(labelled: DataFrame, least: int = 2) -> Tagger:
    """Count a table of (before, tag, word) once and score with one added to every count.

    A word with ``least`` occurrences has scores of its own, any other those of its class. The tables of
    words and classes stay DataFrames; only the matrix of tags comes to the driver, ``MAX_TAGS`` on a side at most.
    """
    seen = materialise(labelled.groupBy("before", "tag", "word").agg(F.count("*").alias("n")), "tag-counts")
    sums = {r["tag"]: r["n"] for r in seen.groupBy("tag").agg(F.sum("n").alias("n")).limit(MAX_TAGS + 1).collect()}
    if len(sums) > MAX_TAGS:
        raise ValueError(f"more than {MAX_TAGS} tags")
    tags = sorted(sums)
    place = {tag: i for i, tag in enumerate([*tags, ""])}
    pairs = seen.groupBy("before", "tag").agg(F.sum("n").alias("n")).collect()
    matrix = np.zeros((len(tags) + 1, len(tags)))
    for r in pairs:
        if r["before"] in place:
            matrix[place[r["before"]], place[r["tag"]]] = r["n"]
    scores = np.log((matrix + 1) / (matrix.sum(1, keepdims=True) + len(tags))) * MILLION
    transitions = (np.sign(scores) * np.floor(np.abs(scores) + 0.5)).astype(np.int64)

    def scored(counts: DataFrame, key: str, kinds: int) -> DataFrame:
        held = counts.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("tag", "n"))).alias("m"))
        each = [_score(F.coalesce(F.element_at("m", F.lit(t)), F.lit(0)), F.lit(float(sums[t])), kinds) for t in tags]
        return held.select(key, F.array(*each).alias("scores"))

    by_word = materialise(seen.groupBy("word", "tag").agg(F.sum("n").alias("n")), "word-tags")
    often = by_word.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("word")
    by_class = by_word.groupBy(word_class(F.col("word")).alias("class"), "tag").agg(F.sum("n").alias("n"))
    known = by_word.join(often, "word", "left_semi")
    kinds = by_class.agg(F.count_distinct("class")).first()[0]
    words = materialise(scored(known, "word", often.count()), "word-scores") if tags else known.select("word", F.lit(None).cast("array<long>").alias("scores"))
    classes = scored(by_class, "class", kinds) if tags else by_class.select("class", F.lit(None).cast("array<long>").alias("scores"))
    unseen = [int(np.floor(np.log(1 / (sums[t] + kinds)) * MILLION + 0.5)) for t in tags]
    return Tagger(tags, transitions, words, materialise(classes, "class-scores"), unseen)


def best_path(emissions: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The tags of the path with the greatest sum; the first tag among equals, from the end backwards."""
    size, tags = emissions.shape
    back = np.zeros((size, tags), np.int64)
    score = transitions[-1] + emissions[0]
    for i in range(1, size):
        through = score[:, None] + transitions[:-1]
        back[i] = through.argmax(0)
        score = through[back[i], np.arange(tags)] + emissions[i]
    path = np.empty(size, np.int64)
    path[-1] = score.argmax()
    for i in range(size - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def tag_sentences(
    messages: DataFrame, tagger: Tagger, key: str = "message_id", sentences: str = "sentences", token: str = "token", name: str = "tags"
) -> DataFrame:
    """Add ``name``, an array of tags for each sentence; ``key`` is unique.

    The distinct words of a message, not its tokens, are joined with their scores, so a frequent word counts once a
    message. A sentence is decoded inside its row, in time proportional to its length.
    """
    held = messages.withColumn("_words", F.transform(sentences, lambda s: F.transform(s, lambda tok: F.coalesce(F.lower(tok[token]), F.lit("")))))
    held = materialise(held, "to-tag")
    distinct = held.select(key, F.explode(F.array_distinct(F.flatten("_words"))).alias("word"))
    own = tagger.words.withColumnRenamed("scores", "_own")
    found = distinct.join(own, "word", "left").withColumn("class", word_class(F.col("word"))).join(tagger.classes, "class", "left")
    scores = F.coalesce("_own", "scores", F.array(*[F.lit(x).cast("long") for x in tagger.unseen])).alias("scores")
    listed = found.groupBy(key).agg(F.collect_list(F.struct("word", scores)).alias("_scores"))
    tags, transitions = np.array(tagger.tags, object), tagger.transitions

    @F.pandas_udf("array<array<string>>")
    def decoded(words: pd.Series, scores: pd.Series) -> pd.Series:
        rows = []
        for sents, known in zip(words, scores):
            place = {} if known is None else {x["word"]: i for i, x in enumerate(known)}
            matrix = np.array([x["scores"] for x in known], np.int64) if place else None
            rows.append([
                tags[best_path(matrix[[place[w] for w in s]], transitions)].tolist() if len(s) and len(tags) else [None] * len(s) for s in sents])
        return pd.Series(rows)

    joined = held.join(listed, key, "left")
    return joined.select(*messages.columns, decoded("_words", "_scores").alias(name))
