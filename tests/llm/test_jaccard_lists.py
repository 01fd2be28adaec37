"""Lists of the Jaccard join that hold the same rows."""

from __future__ import annotations

import random

from corpusloom.llm import jaccard_join
from corpusloom.llm.jaccard_join import distinct_lists, jaccard_components


def test_near_copies_are_compared_in_one_list(spark, monkeypatch):
    """Two texts of 600 words that differ in three share a list for most elements of their prefixes; before, all were dealt."""
    rng, rows = random.Random(3), []
    for group in range(4):
        words = [f"w{rng.randrange(10**6)}" for _ in range(600)]
        for copy in range(2):
            for k in range(3):
                words[100 + 150 * k] = f"x{group}-{copy}-{k}"
            rows.append((2 * group + copy, " ".join(words)))
    dealt, held = [], jaccard_join.materialise

    def watched(df, name):
        out = held(df, name)
        if name == "cells":
            dealt.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "materialise", watched)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_components(docs, 5, 80).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}
    assert dealt and max(dealt) <= len(rows)


def test_distinct_lists(spark):
    members = {1: "ab", 2: "ab", 3: "abc", 4: "bc", 5: "bc", 6: "ad", 7: "aA"}  # a and A share an id, not a set
    ids = {"a": 10, "A": 10, "b": 11, "c": 12, "d": 13}
    rows = [(key, ids[m], m.encode(), min(ids[x] for x in own), len(own)) for key, own in members.items() for m in own]
    lists = spark.createDataFrame(rows, "key long, id long, print binary, head long, rows long")
    got = {(r.key, r.id, r.head, r.rows) for r in distinct_lists(lists).collect()}
    assert got == {(key, i, head, n) for key, i, _, head, n in rows if key not in (2, 5)}
