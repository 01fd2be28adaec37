"""A stream of turns in any order gives what the whole conversation gives."""

import random

import pytest

from corpusloom.streaming import conversations, jobs

SCHEMA = "conv_id string, turn int, role string, text string"


def turns(seed):
    rng = random.Random(seed)
    rows = []
    for conv in ["hot", "hot2", "short", None, *map(str, range(12))]:
        for turn in range(200 if conv == "hot" else rng.randrange(1, 9)):
            said = rng.choice(["hello there", " ", None, "more", "quit" if rng.random() < (0.02 if conv == "hot" else 0.3) else "x", "BYE "])
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", None]), said))
    rng.shuffle(rows)
    return rows


def plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        spoken = [r for r in own if (r[3] or "").strip()]
        stop = min((r[1] for r in spoken if r[2] == "user" and r[3].strip().lower() in ("quit", "exit", "bye", "q")), default=None)
        kept = [r for r in spoken if stop is None or r[1] < stop]
        out[conv] = (len(own), stop, len(kept), sum(len(r[3]) for r in kept), max((r[1] for r in kept), default=None))
    return out


@pytest.mark.parametrize("batches", [1, 5])
def test_stream_equals_the_whole(spark, tmp_path, batches):
    rows = turns(batches)
    for i in range(batches):
        spark.createDataFrame(rows[i::batches], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    arriving = jobs.file_stream(spark, str(tmp_path / "in"), "*.parquet", SCHEMA, files_per_batch=1)
    written = jobs.run_available(conversations.conversation_states(arriving), "states")
    assert written.count() >= len(plain(rows)) and (batches == 1) == (written.count() == len(plain(rows)))
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.present_states(written).collect()}
    assert got == plain(rows)


class Held:
    """A state as the engine hands it over."""

    def __init__(self, value=None, timed_out=False):
        self.get, self.exists, self.hasTimedOut, self.after = value, value is not None, timed_out, None

    def update(self, value):
        self.get, self.exists = value, True

    def remove(self):
        self.get, self.exists = None, False

    def setTimeoutDuration(self, after):
        self.after = after


def test_silent_conversations_are_forgotten():
    import pandas as pd

    state = Held()
    part = pd.DataFrame({"turn": [0, 1], "size": [3, 4], "blank": [False, False], "stops": [False, False]})
    first, = conversations.follow(("c",), iter([part]), state, 60)
    assert first.iloc[0].tolist()[1:2] + first.iloc[0].tolist()[3:] == [2, 2, 7, 1] and state.after == 60_000
    state.hasTimedOut = True
    assert list(conversations.follow(("c",), iter([]), state, 60)) == [] and not state.exists


def test_requests_are_scored_together(spark):
    from pyspark.sql import functions as F

    from corpusloom.operators import models

    words = ["pantry printer jam", "password reset locked", "database outage critical"]
    rows = [(i, f"[Incident] {words[i % 3]} | item {i}", i % 3, "train" if i % 10 < 8 else "val") for i in range(120)]
    model, _ = models.fit_priority_model(spark.createDataFrame(rows, "id int, text string, label int, split string"), budgets=(8,))
    bodies = [
        (1, '{"tickets":[{"text":"database outage critical"},{"text":" "},{"type":"Incident","subject":"pantry printer jam","body":null}]}'),
        (2, '{"tickets":[]}'), (3, "no json"), (4, None), (5, '{"tickets":[{"subject":"password reset locked"}]}'),
    ]
    frame = spark.createDataFrame(bodies, "request int, body string")
    got = {r["request"]: r for r in models.score_requests(frame, model, ["request"], F.col("body")).collect()}
    assert {i: r["count"] for i, r in got.items()} == {1: 2, 2: 0, 3: 0, 4: 0, 5: 1}
    assert [(x["ticket_no"], x["predicted_priority"]) for x in got[1]["results"]] == [(0, "high"), (2, "low")]
    assert got[5]["results"][0]["predicted_priority"] == "medium"
