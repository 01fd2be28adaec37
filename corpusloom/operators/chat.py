"""Multi-turn conversations grounded in a knowledge text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as w

from corpusloom.functions import text as t
from corpusloom.functions import vocab
from corpusloom.functions.arrays import explode_rows
from corpusloom.operators.ordering import salted_join

TURN_RANGE = 1024

GROUNDED_PROMPT = "Reply from the facts listed here and from nothing else; say so when they do not help.\n\nFACTS\n{knowledge}\n"
# Fixed value: how a question follows its instructions.
QUESTION_PROMPT = "{system}\n\nUser question:\n{question}"


def gate_turns(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    text: str = "text",
    stop_words: list[str] = vocab.STOP_TURNS,
    command: Column | None = None,
    role: str | None = "role",
    speaker: str = "user",
) -> DataFrame:
    """Drop blank turns and everything from the first stop word of a conversation on.

    Only turns of the ``speaker`` end a conversation, all turns if ``role`` is None. ``command`` is the text compared
    with the stop words, by default the whole turn.
    """
    said = F.lower(t.strip(F.col(text) if command is None else command))
    spoken = turns.where(~t.blank(F.col(text)))
    own = F.lit(True) if role is None else F.col(role) == speaker
    stops = spoken.where(own & said.isin(stop_words)).groupBy(conversation).agg(F.min(turn).alias("_stop"))
    kept = salted_join(spoken, stops, [conversation], how="left")
    return kept.where(F.col("_stop").isNull() | (F.col(turn) < F.col("_stop"))).select(*turns.columns)


def history(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    width: int = TURN_RANGE,
) -> DataFrame:
    """What came before each turn: number of turns, characters, and the last role and text.

    The history of a turn is the set of rows of its conversation with a smaller turn number; it is
    described, not copied into every row, for copies would grow with the square of a conversation.
    Turns are cut into ranges: windows run within a range, and one row per range carries over.
    """
    ranged = turns.withColumn("_range", F.col(turn) - F.pmod(F.col(turn), F.lit(width)))
    keys = [conversation, "_range"]
    last = F.struct(F.col(role).alias("role"), F.col(text).alias("text"))
    sums = ranged.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.sum(F.length(text)).alias("_chars"), F.max_by(last, F.col(turn)).alias("_last")
    )
    over = w.Window.partitionBy(conversation).orderBy("_range")
    earlier = over.rowsBetween(w.Window.unboundedPreceding, -1)
    carried = sums.select(
        *keys,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_chars").over(earlier), F.lit(0)).alias("_c0"),
        F.lag("_last").over(over).alias("_last0"),
    )
    local = w.Window.partitionBy(*keys).orderBy(turn)
    before = local.rowsBetween(w.Window.unboundedPreceding, -1)
    inside = ranged.select(
        "*",
        F.row_number().over(local).alias("_r"),
        F.coalesce(F.sum(F.length(text)).over(before), F.lit(0)).alias("_c"),
        F.lag(last).over(local).alias("_prev"),
    )
    prev = F.coalesce(F.col("_prev"), F.col("_last0"))
    return inside.join(carried, keys).select(
        *turns.columns,
        (F.col("_n0") + F.col("_r") - 1).alias("history_turns"),
        (F.col("_c0") + F.col("_c")).alias("history_chars"),
        prev["role"].alias("prev_role"),
        prev["text"].alias("prev_text"),
    )


def grounded_prompts(questions: DataFrame, knowledge: Column, question: str, template: str = GROUNDED_PROMPT) -> DataFrame:
    """Add ``prompt``: the template filled with the knowledge text, followed by the question."""
    system = t.fill(template, knowledge=knowledge)
    return questions.withColumn("prompt", t.fill(QUESTION_PROMPT, system=system, question=F.col(question)))


def credential_candidates(df: DataFrame, key: str, text: str, pattern: str) -> DataFrame:
    """One row per credential-like piece of text, with its class."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    rows = explode_rows(df, [key], found, "candidate", "candidate_no")
    return rows.withColumn("class", t.credential_class(F.col("candidate")))
