"""Words, word families and affixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.functions import vocab
from corpusloom.functions.arrays import explode_rows
from corpusloom.functions.stemming import add_stems
from corpusloom.operators.ordering import salted_join


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """(word, n) over the white-space separated, lower-cased words of all texts."""
    return explode_rows(df, [], t.split_words(F.col(text)), "word").groupBy("word").agg(F.count("*").alias("n"))


def letter_word_counts(df: DataFrame, text: str) -> DataFrame:
    """(word, n) over the lower-cased runs of letters of all texts."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    return explode_rows(df, [], found, "word").groupBy("word").agg(F.count("*").alias("n"))


def suffix_key(word: Column) -> Column:
    """The word without its first fitting suffix."""
    suffix = t.first_suffix(word)
    return F.coalesce(F.substring(word, F.lit(1), F.length(word) - F.length(suffix)), word)


def families(words: DataFrame, root: Column) -> DataFrame:
    """Distinct words by root, with members in order, their number and their uses.

    ``words`` is (word, n) with distinct words. A root only gains members by attaching endings from
    a fixed list, so member lists stay short whatever the size of the corpus.
    """
    keyed = words.withColumn("root", root)
    return keyed.groupBy("root").agg(
        F.array_sort(F.collect_list("word")).alias("members"), F.count("*").alias("size"), F.sum("n").alias("uses")
    )


def stem_families(words: DataFrame) -> DataFrame:
    return families(add_stems(words), F.col("stem"))


def affixes(words: DataFrame, short: bool = False) -> DataFrame:
    """Prefix, suffix and affix class of every word."""
    word = F.lower(t.strip(F.col("word")))
    found = words.withColumn("prefix", t.first_prefix(word)).withColumn("suffix", t.first_suffix(word))
    return found.withColumn("affix_class", t.affix_class(F.col("prefix"), F.col("suffix"), short))


def without_stopwords(df: DataFrame, word: str = "word", stopwords: list[str] = vocab.STOPWORDS) -> DataFrame:
    return df.where(~F.lower(F.col(word)).isin(stopwords))


def vocabulary_hits(tokens: DataFrame, vocabulary: DataFrame, token: str) -> DataFrame:
    """Tokens that occur in a vocabulary table of any size; frequent tokens are spread."""
    words = vocabulary.select(F.col("word").alias(token)).distinct()
    return salted_join(tokens, words, [token], how="left_semi")
