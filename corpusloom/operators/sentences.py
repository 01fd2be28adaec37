"""Sentence breaks that know the abbreviations of the corpus (after Kiss and Strunk, 2006).

A word that nearly always has a stop behind it, is short and is seldom met without one is an abbreviation;
a stop behind it ends no sentence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.functions.arrays import explode_rows
from corpusloom.session import materialise

WORD = r"\p{L}+(?:\.\p{L}+)*"
#: A break is marked by this character, which also breaks a text that holds it.
MARK = "\u0001"
LEAST_SCORE = 0.3
STOP_CHANCE = 0.99


def abbreviation_scores(texts: DataFrame, text: str = "raw_text") -> DataFrame:
    """(word, n, n_stop, score) of every lower-cased word with a stop behind it at least once.

    ``score`` compares two explanations of the stops by their log-likelihood ratio: that the word has one as often as any
    word, and that it nearly always has one. It falls with the length of the word and with every occurrence
    without a stop, and rises with stops inside. One aggregate over all texts, combined before the shuffle.
    """
    found = F.regexp_extract_all(F.lower(text), F.lit(WORD + r"\.?"), F.lit(0))
    words = explode_rows(texts, [], found, "w").select(F.rtrim("w", F.lit(".")).alias("word"), F.endswith("w", F.lit(".")).alias("stop"))
    counts = materialise(words.groupBy("word").agg(F.count("*").alias("n"), F.count_if("stop").alias("n_stop")), "word-stops")
    chance = counts.agg((F.sum("n_stop") / F.sum("n")).alias("p")).scalar()
    held = counts.where("n_stop > 0").withColumn("p", F.least(chance, F.lit(1 - 1e-9)))
    without = F.col("n") - F.col("n_stop")
    plain = F.col("n_stop") * F.log("p") + without * F.log(1 - F.col("p"))
    nearly = F.col("n_stop") * F.log(F.lit(STOP_CHANCE)) + without * F.log(F.lit(1 - STOP_CHANCE))
    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    inside = F.length("word") - letters
    score = 2 * (nearly - plain) * F.exp(-letters) * (inside + 1) * F.pow(letters.cast("double"), -without)
    return held.select("word", "n", "n_stop", score.alias("score"))


def abbreviations(scores: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """(word) with a score of ``least`` or more."""
    return scores.where(F.col("score") >= least).select("word")


def last_word(part: Column) -> Column:
    """The lower-cased word before the final stop, blank if there is none."""
    return F.lower(F.regexp_extract(part, rf"(?:^|[^\p{{L}}.])({WORD})\.$", 1))


def learnt_sentences(messages: DataFrame, known: DataFrame, text: str = "raw_text", key: str = "message_id", name: str = "sentence") -> DataFrame:
    """(key, sent_idx, sentence): breaks at white space behind ``.!?``, but not behind the stop of a word of ``known``.

    ``key`` is unique. Words before a stop are looked up by a join, once for each message and word; a text is cut, marked
    and put together again in its row, in time proportional to its length. Blank sentences are left out.
    """
    parts = F.split(F.col(text), r"(?<=[.!?])(?=\s)")
    held = materialise(messages.select(key, parts.alias("parts")), "parts")
    asked = held.select(key, F.explode(F.array_distinct(F.transform("parts", last_word))).alias("word")).where("word <> ''")
    own = asked.join(known.select("word").distinct(), "word").groupBy(key).agg(F.collect_set("word").alias("short"))
    joined = held.join(own, key, "left")
    closes = lambda part: F.array_contains(F.coalesce("short", F.array().cast("array<string>")), last_word(part))
    marked = F.transform("parts", lambda part: F.when(closes(part), part).otherwise(F.concat(part, F.lit(MARK))))
    whole = F.split(F.array_join(marked, ""), MARK)
    kept = F.filter(F.transform(whole, lambda s: F.regexp_replace(s, r"^\s+", "")), lambda s: t.strip(s) != "")
    return explode_rows(joined.withColumn("whole", kept), [key], F.col("whole"), name, "sent_idx")
