"""Listed entities and tree depths against plain versions."""

import random

import pytest

from corpusloom.operators import depth, gazetteer


def plain_spans(tokens, entries):
    known, out, at = {}, [], 0
    for phrase, kind in entries:
        words = tuple((phrase or "").lower().split())
        if words:
            known[words] = min(kind, known.get(words, kind))
    while at < len(tokens):
        fits = [n for n in range(1, 9) if at + n <= len(tokens) and tuple((t or "").lower() for t in tokens[at : at + n]) in known]
        if fits:
            n = max(fits)
            out.append((at, n, " ".join(t or "" for t in tokens[at : at + n]), known[tuple((t or "").lower() for t in tokens[at : at + n])]))
        at += max(fits, default=1)
    return out


def test_longest_entries_without_overlap(spark):
    rng = random.Random(1)
    words = ["New", "york", "City", "hall", "of", "the", "Park"]
    entries = [(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 6))), rng.choice("ab")) for _ in range(60)]
    entries += [("the  PARK", "b"), ("", "x"), (None, "x"), ("absent words", "z")]
    messages = [[rng.choice(words + ["x", None]) for _ in range(rng.randrange(40))] for _ in range(80)] + [[], None, ["the"] * 5000]
    frame = spark.createDataFrame([(i, t, "c") for i, t in enumerate(messages)], "message_id int, tokens array<string>, kind string")
    known = gazetteer.gazetteer_entries(spark.createDataFrame(entries, "phrase string, kind string"))
    got = {}
    for r in gazetteer.entity_spans(frame.repartition(3), known).collect():
        got.setdefault(r["message_id"], []).append((r["start_idx"], r["n_tokens"], r["entity"], r["kind"]))
    entries = [e for e in entries if e[0]]
    assert {i: sorted(x) for i, x in got.items()} == {i: x for i, t in enumerate(messages) if t and (x := plain_spans(t, entries))}
    assert gazetteer.entity_spans(frame, known.limit(0)).collect() == []


def plain_depth(heads):
    """Levels under the first root, by walking up from every token."""
    roots = [i for i, h in heads.items() if h == i]
    if not roots:
        return None
    best = 0
    for i in heads:
        seen, at, far = set(), i, 0
        while at in heads and heads[at] != at and at not in seen:
            seen.add(at)
            at, far = heads[at], far + 1
        if at == min(roots):
            best = max(best, far)
    return best + 1


def test_depths_of_random_forests(spark):
    rng, groups = random.Random(2), {}
    for g in range(60):
        nodes = rng.sample(range(1000), rng.randrange(1, 30))
        groups[(g % 7 if g % 11 else None, g)] = {i: rng.choice([*nodes, i, i, 5000]) for i in nodes}
    rows = [(*g, i, h) for g, heads in groups.items() for i, h in heads.items()]
    frame = spark.createDataFrame(rows, "message_id int, sent_idx int, token_idx int, head_idx int")
    got = {(r["message_id"], r["sent_idx"]): r["depth"] for r in depth.tree_depths(frame, ["message_id", "sent_idx"]).collect()}
    assert got == {g: d for g, heads in groups.items() if (d := plain_depth(heads)) is not None}
    assert depth.tree_depths(frame.limit(0), ["message_id"]).collect() == []


@pytest.mark.parametrize("size", [1, 2, 100_000])
def test_chain_of_heads(spark, size):
    chain = spark.range(size).selectExpr("1 AS m", "id AS token_idx", "greatest(id - 1, 0) AS head_idx")
    assert [tuple(r) for r in depth.tree_depths(chain, ["m"]).collect()] == [(1, size)]


def test_depths_of_gathered_and_joined_groups_agree(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(g if g else None, 3 * i, 3 * rng.randrange(-1, i + 1)) for g in range(9) for i in range(rng.randrange(1, 9))]
    rows += [(100, 0, 0), (100, 3, 0), (100, 6, 0), (100, 6, 3)]
    frame = spark.createDataFrame(rows, "m int, token_idx int, head_idx int")
    gathered = sorted(map(str, depth.tree_depths(frame, ["m"]).collect()))
    calls, joined = [], depth._joined_depths
    monkeypatch.setattr(depth, "_joined_depths", lambda *a: calls.append(1) or joined(*a))
    monkeypatch.setattr(depth, "ROW_TOKENS", 0)
    assert sorted(map(str, depth.tree_depths(frame, ["m"]).collect())) == gathered and calls
    monkeypatch.setattr(depth, "ROW_TOKENS", 4096)
    calls.clear()
    depth.tree_depths(frame.where("m <> 100"), ["m"]).collect()
    assert not calls  # no round of joins


def test_listed_entities_go_to_python_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        known = gazetteer.gazetteer_entries(spark.createDataFrame([("w 1", "k")], "phrase string, kind string"))
        rows = [(i, ["w", "1"]) for i in range(2500)]
        found = gazetteer.entity_spans(spark.createDataFrame(rows, "message_id long, tokens array<string>").coalesce(1), known)
        assert found.count() == 2500 and int(spark.conf.get(key)) <= 1000
    finally:
        spark.conf.set(key, before)
