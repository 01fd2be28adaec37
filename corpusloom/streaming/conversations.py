"""Conversations followed as their turns arrive, in any order, with state for each."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusloom.functions import text as t
from corpusloom.functions import vocab

STATE = "stop long, seen long, turns array<long>, sizes array<long>"
RESULT = "version long, stop long, kept_turns long, kept_chars long, last_turn long"


def follow(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState, expire_seconds: int | None) -> Iterator[pd.DataFrame]:
    """The state of one conversation brought up to the turns that have arrived, or dropped when its time is over."""
    if state.hasTimedOut:
        state.remove()
        return
    stop, seen, numbers, sizes = state.get if state.exists else (None, 0, [], [])
    known = dict(zip(numbers, sizes))
    for part in parts:
        seen += len(part)
        spoken = part[~part["blank"]]
        stops = spoken.loc[spoken["stops"], "turn"]
        if len(stops):
            stop = int(stops.min()) if stop is None else min(stop, int(stops.min()))
        known.update(zip(spoken["turn"].tolist(), spoken["size"].tolist()))
    known = {int(n): int(size) for n, size in known.items() if stop is None or n < stop}
    state.update((stop, seen, list(known), list(known.values())))
    if expire_seconds is not None:
        state.setTimeoutDuration(1000 * expire_seconds)
    row = (key[0], seen, stop, len(known), sum(known.values()), max(known, default=None))
    frame = pd.DataFrame([row], columns=["conv", "version", "stop", "kept_turns", "kept_chars", "last_turn"])
    yield frame.astype({"stop": "Int64", "last_turn": "Int64"})


def conversation_states(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    speaker: str = "user",
    stop_words: list[str] = vocab.STOP_TURNS,
    command: Column | None = None,
    expire_seconds: int | None = None,
) -> DataFrame:
    """(conversation, version, stop, kept_turns, kept_chars, last_turn): a row whenever turns of a conversation arrive.

    A stream of turns to a stream of what is known of each conversation: the first turn at which the ``speaker`` says a
    stop word, and number, characters and last one of the turns before it that are not blank. ``version`` counts the
    turns that have arrived, so the row with the greatest is the present one. Turns may arrive in any order and in any
    batches: a stop that turns up late takes back what was counted behind it. The state holds the numbers and sizes of
    the turns before the stop, no texts. Null counts as blank text, and a null conversation is one.

    With ``expire_seconds`` the state is dropped when a conversation has been silent for so long; that is for streams
    that go on, for a run over what is there would wait for the next expiry for ever.
    """
    said = F.lower(t.strip(F.col(text) if command is None else command))
    marked = turns.select(
        F.col(conversation).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("size"),
        t.blank(F.col(text)).alias("blank"), F.coalesce((F.col(role) == speaker) & said.isin(stop_words), F.lit(False)).alias("stops"),
    )
    kind = dict(marked.dtypes)["conv"]
    timeout = GroupStateTimeout.NoTimeout if expire_seconds is None else GroupStateTimeout.ProcessingTimeTimeout

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        yield from follow(key, parts, state, expire_seconds)

    states = marked.groupBy("conv").applyInPandasWithState(step, f"conv {kind}, {RESULT}", STATE, "append", timeout)
    return states.withColumnRenamed("conv", conversation)


def present_states(states: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """The latest row of each conversation among all that a stream has written."""
    rest = [c for c in states.columns if c != conversation]
    return states.groupBy(conversation).agg(F.max(F.struct(*rest)).alias("s")).select(conversation, "s.*")
