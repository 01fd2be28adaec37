"""Entities of several words from a list: the longest entry at each place, without overlap."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialise, small_batches


def gazetteer_entries(entries: DataFrame, phrase: str = "phrase", kind: str = "kind") -> DataFrame:
    """(phrase, kind, size, first): lower-cased, words parted by one blank; the least kind of equal phrases."""
    words = F.filter(F.split(F.lower(phrase), r"\s+"), lambda w: w != "")
    rows = entries.select(words.alias("w"), F.col(kind).alias("kind")).where(F.size("w") > 0)
    rows = rows.groupBy(F.array_join("w", " ").alias("phrase")).agg(F.min("kind").alias("kind"), F.first(F.size("w")).alias("size"))
    return rows.withColumn("first", F.substring_index("phrase", " ", 1))


def entity_spans(messages: DataFrame, entries: DataFrame, key: str = "message_id", tokens: str = "tokens") -> DataFrame:
    """(key, start_idx, n_tokens, entity, kind), a row for each entry found; ``tokens`` is an array of words and ``key`` unique.

    Matching ignores case. From the left, the longest entry that begins at a token is taken, and the search goes on behind it.
    ``entries`` comes from :func:`gazetteer_entries` and may be of any size: a message first learns which lengths
    begin with its words, by a join of its distinct words with a table of first words, and then which of its
    phrases of those lengths are entries, by a join of its distinct phrases. Neither table is collected. Messages
    go to Python in small batches, for their words take many times the memory of the texts there.

    The words are written once and shuffled once: both joins that need them read the same columns of the same rows. The words in lower case are made
    where they are read.
    """
    small_batches(messages.sparkSession)
    held = materialise(messages.select(key, F.col(tokens).alias("_tokens")).where("_tokens IS NOT NULL"), "to-match")
    low = F.transform("_tokens", lambda w: F.coalesce(F.lower(w), F.lit("")))
    firsts = entries.groupBy("first").agg(F.array_sort(F.collect_set("size"), lambda a, b: b - a).alias("sizes"))
    words = held.select(key, F.explode(F.array_distinct(low)).alias("first")).join(firsts, "first")
    begins = words.groupBy(key).agg(F.collect_list(F.struct("first", "sizes")).alias("_begins"))

    @F.pandas_udf("array<struct<phrase string, n int, head int>>")
    def phrases(low: pd.Series, begins: pd.Series) -> pd.Series:
        rows = []
        for words, own in zip(low, begins):
            words, sizes = list(words), {x["first"]: x["sizes"] for x in own}
            found = {(" ".join(words[i : i + n]), int(n), len(w)) for i, w in enumerate(words) for n in sizes.get(w, ()) if i + n <= len(words)}
            rows.append([{"phrase": phrase, "n": n, "head": head} for phrase, n, head in found])
        return pd.Series(rows)

    asked = held.join(begins, key).select(key, F.inline(phrases(low, "_begins")))
    found = asked.join(entries.select("phrase", "kind"), "phrase").groupBy(key).agg(F.collect_list(F.struct("phrase", "n", "head", "kind")).alias("_found"))

    @F.pandas_udf("array<struct<start_idx int, n_tokens int, entity string, kind string>>")
    def spans(tokens: pd.Series, low: pd.Series, found: pd.Series) -> pd.Series:
        rows = []
        for words, lows, known in zip(tokens, low, found):
            words, lows = ["" if w is None else w for w in words], list(lows)
            sizes, kinds, at, out = {}, {x["phrase"]: x["kind"] for x in known}, 0, []
            for first, n in sorted({(x["phrase"][: x["head"]], x["n"]) for x in known}, key=lambda x: -x[1]):
                sizes.setdefault(first, []).append(n)
            while at < len(lows):
                n = next((n for n in sizes.get(lows[at], ()) if at + n <= len(lows) and " ".join(lows[at : at + n]) in kinds), 0)
                if n:
                    out.append({"start_idx": at, "n_tokens": int(n), "entity": " ".join(words[at : at + n]), "kind": kinds[" ".join(lows[at : at + n])]})
                at += n or 1
            rows.append(out)
        return pd.Series(rows)

    matched = held.join(found, key).select(key, F.explode(spans("_tokens", low, "_found")).alias("s"))
    return matched.select(key, "s.*")
