"""Corpus building: select, normalise, merge, clean, deduplicate, expand."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.operators.ordering import positions


def filter_messages(raw: DataFrame, source: str, prefix: str = "KG") -> DataFrame:
    """(message_id, raw_text, source); rows with ``target`` 1 only, when there is such a column."""
    kept = raw.where(F.col("target") == 1) if "target" in raw.columns else raw
    return kept.select(
        t.prefixed_id(F.col("id"), prefix).alias("message_id"), F.col("text").alias("raw_text"), F.lit(source).alias("source")
    )


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, in the columns of the first; ``source_rank`` is the place of the frame."""
    ranked = [f.withColumn("source_rank", F.lit(i)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b), ranked)


def keep_first(df: DataFrame, value: str, order: list[str]) -> DataFrame:
    """One row per ``value``: the first by ``order``.

    A minimum instead of a ranking window: copies are reduced before the shuffle, so a text that
    fills a third of the table costs no more than any other.
    """
    rest = [c for c in df.columns if c != value and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return df.groupBy(value).agg(first).select(value, "_first.*").select(*df.columns)


def clean_corpus(df: DataFrame, more_than: int = 10, value: str = "raw_text", order: list[str] | None = None) -> DataFrame:
    """Strip the text, drop short texts, keep the first of equal texts."""
    stripped = df.withColumn(value, t.strip(F.col(value).cast("string")))
    kept = stripped.where(F.length(value) > more_than)
    return keep_first(kept, value, order or ["message_id"])


def load_responses(df: DataFrame, more_than: int = 20) -> DataFrame:
    """Responses in their five columns, stripped, long enough, with normalised labels."""
    text = t.strip(F.col("response_text").cast("string"))
    return (
        df.select("response_id", "prompt_id", "prompt", text.alias("response_text"), t.normalised_label(
            F.col("source_type").cast("string")).alias("source_type"))
        .where(F.length("response_text") > more_than)
    )


def label_audit(df: DataFrame, label: str, allowed: list[str]) -> DataFrame:
    """Rows and rows whose label is null or not allowed."""
    bad = ~F.coalesce(F.col(label).isin(allowed), F.lit(False))
    return df.agg(F.count("*").alias("rows"), F.count_if(bad).alias("odd_rows"))


def renumber(df: DataFrame, key: str, name: str = "row_no") -> DataFrame:
    """Number the rows 0, 1, 2, ... by a key; rows without one come last."""
    return positions(df, key, name=name).withColumn(name, F.col(name) - 1)


def expand_templates(
    prompts: DataFrame, templates: DataFrame, fillers: DataFrame, source: str, prefix: str, per_prompt: int = 4
) -> DataFrame:
    """``per_prompt`` texts for every prompt, from the templates and fillers of its category.

    ``prompts`` has a ``prompt_no`` that fixes the order of the running ids. ``templates``
    is (category, templates ARRAY<STRING>), ``fillers`` is (category, fillers ARRAY<STRUCT<a, b>>);
    both are cycled. Null is a category like any other; a prompt whose category has no templates gets null
    texts. A pattern is filled in one pass: what a filler holds is not filled again.
    """
    patterns = templates.select(F.col("category").alias("_c"), F.col("templates").alias("_t"))
    pairs = fillers.select(F.col("category").alias("_d"), F.col("fillers").alias("_f"))
    numbered = (
        positions(prompts, "prompt_no")
        .join(patterns, F.col("category").eqNullSafe(F.col("_c")), "left")
        .join(pairs, F.col("category").eqNullSafe(F.col("_d")), "left")
        .withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(per_prompt - 1))))
    )
    pattern = F.get("_t", F.pmod("_i", F.size("_t")))
    pair = F.get("_f", F.pmod("_i", F.size("_f")))
    between = F.split(pattern, r"\{a\}")
    filled = F.transform(between, lambda part: F.replace(part, F.lit("{b}"), pair["b"]))
    text = F.call_function("array_join", filled, pair["a"])
    number = (F.col("position") - 1) * per_prompt + F.col("_i") + 1
    return numbered.select(
        t.running_id(number, prefix).alias("response_id"),
        "prompt_id",
        "prompt",
        text.alias("response_text"),
        F.lit(source).alias("source_type"),
    )


def fan_out(prompts: DataFrame, answer: Column, per_prompt: int = 5, prefix: str = "AI", more_than: int = 20) -> DataFrame:
    """``per_prompt`` request rows for every prompt with running ids; short answers are dropped.

    ``answer`` is an expression over the prompt row and ``replica`` (0, 1, ...).
    """
    numbered = positions(prompts, "prompt_no").withColumn(
        "replica", F.explode(F.sequence(F.lit(0), F.lit(per_prompt - 1)))
    )
    number = (F.col("position") - 1) * per_prompt + F.col("replica") + 1
    return numbered.select(
        t.running_id(number, prefix).alias("response_id"),
        "prompt_id",
        "prompt",
        F.coalesce(t.strip(answer), F.lit("")).alias("response_text"),
        F.lit("AI").alias("source_type"),
    ).where(F.length("response_text") > more_than)
