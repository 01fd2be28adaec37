"""Annotating and tagging on Arrow batches: how often words are looked at, slices, and messages without tokens."""

import random

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.operators import annotate as an
from corpusloom.operators import features as ft
from corpusloom.operators import tagging as tg

WORDS = ["we", "saw", "Delhi", "Police", "is", "trapped", "cities", "near", "bridge", "7", "-", "quickly", "HELP", "army", "."]


def random_messages(seed, n):
    rng = random.Random(seed)
    return [[[rng.choice(WORDS) for _ in range(rng.randrange(1, 12))] for _ in range(rng.randrange(0, 5))] for _ in range(n)]


def annotated(messages):
    return an.Annotated(pa.array(messages, pa.list_(pa.list_(pa.string()))), an.POS)


def test_rules_of_a_word_run_once_however_often_it_occurs():
    an._facts.cache_clear()
    a = annotated([[["boats", "reached", "Delhi"] * 1000]] * 20)
    assert len(a.columns(an.LONG_FIELDS)) == 60_000
    assert an._facts.cache_info().misses == 4  # "boats" opens a sentence and stands inside


def test_no_rule_is_interpreted_for_each_token(spark):
    df = spark.createDataFrame([(1, "We saw Delhi Police go to Pune. Rain.")], "message_id int, raw_text string")
    for found in (an.annotate(df), an.annotate_long(df), tg.tag_corpus(df)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("lambdafunction(") <= 2 and "aggregate(" not in plan  # those that cut the words
    rows = ft.token_columns(tg.tag_corpus(df))._jdf.queryExecution().optimizedPlan().toString()
    assert "named_struct" not in rows


@pytest.mark.parametrize("size", [1, 7, 1 << 18])
def test_slices_hold_whole_messages_and_change_nothing(monkeypatch, size):
    monkeypatch.setattr(an, "SLICE_TOKENS", size)
    messages = random_messages(size, 60) + [[], [["Delhi"] * 30]]
    words = pa.array(messages, pa.list_(pa.list_(pa.string())))
    sizes = np.array([sum(map(len, m)) for m in messages])
    parts = [an.Annotated(part, an.POS) for part in an.sliced(words, sizes)]
    got = [row for a in parts for row in a.by_message(a.columns(an.LONG_FIELDS)).to_pylist()]
    whole = annotated(messages)
    assert got == whole.by_message(whole.columns(an.LONG_FIELDS)).to_pylist()
    assert [len(row) for row in got] == sizes.tolist()
    assert [[[t["token"] for t in s] for s in m] for m in whole.by_sentence(whole.columns(["token"])).to_pylist()] == messages


def test_null_and_empty_token_arrays(spark):
    kind = "message_id int, tokens array<struct<token:string,pos:string,tag_:string,dep:string,lemma:string,ent_pos:int>>"
    df = spark.createDataFrame([(1, None), (2, []), (3, [("in", "ADP", None, None, "in", None), (None, "NOUN", None, None, None, None)])], kind)
    got = {r["message_id"]: r["tokens"] for r in tg.add_bio_tags(df).collect()}
    assert got[1] is None and got[2] == [] and [t["bio_tag"] for t in got[3]] == ["O", "B-LOC"]
    rows = ft.token_columns(df.selectExpr("message_id", "transform(tokens, t -> named_struct('token', t.token, 'pos', t.pos, 'dep', t.dep, 'lemma', t.lemma, 'is_ent', 0)) AS tokens"))
    assert [(r.message_id, r.token_idx, r.prev_pos, r.next_pos, r.prev_is_prep, r.n_tokens) for r in rows.orderBy("token_idx").collect()] == [
        (3, 0, "X", "NOUN", 0, 2), (3, 1, "ADP", "X", 1, 2)]
