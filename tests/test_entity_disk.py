"""Matching listed entities writes and shuffles the words once."""

import random

from corpusloom.operators import gazetteer


def test_words_are_written_and_shuffled_once(spark, monkeypatch):
    written, real = [], gazetteer.materialise
    monkeypatch.setattr(gazetteer, "materialise", lambda df, name: written.append(df.columns) or real(df, name))
    rng = random.Random(5)
    words = ["New", "york", "New York", "city", "hall", None, "b"]
    rows = [(i % 50, [rng.choice(words) for _ in range(rng.randrange(12))]) for i in range(60)] + [(99, None), (None, ["new", "york"])]
    entries = gazetteer.gazetteer_entries(spark.createDataFrame(
        [("new york", "place"), ("New  York city", "city"), ("york city", "other"), ("hall b", "room"), ("new york", "area")], "phrase string, kind string"))
    found = gazetteer.entity_spans(spark.createDataFrame(rows, "message_id int, tokens array<string>"), entries)
    kinds = {"new york": "area", "new york city": "city", "york city": "other", "hall b": "room"}
    sizes = {"new": (3, 2), "york": (2,), "hall": (2,)}
    expected = []
    for key, tokens in rows:
        low, at = [(w or "").lower() for w in tokens or []], 0
        while at < len(low) and key is not None:
            n = next((n for n in sizes.get(low[at], ()) if at + n <= len(low) and " ".join(low[at : at + n]) in kinds), 0)
            if n:
                expected.append((key, at, n, " ".join(w or "" for w in tokens[at : at + n]), kinds[" ".join(low[at : at + n])]))
            at += n or 1
    assert expected and sorted(map(tuple, found.collect())) == sorted(expected)
    assert written == [["message_id", "_tokens"]]
    monkeypatch.undo()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = gazetteer.entity_spans(spark.createDataFrame(rows, "message_id int, tokens array<string>"), entries)
        plan.collect()
        final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = [x for x in final.splitlines() if "Exchange" in x and "_tokens" in x]
    assert len(shuffled) == 1 and "ReusedExchange" in shuffled[0]
