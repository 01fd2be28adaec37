import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import chat, corpus, counting, ordering, split
from corpusloom.plans import flows


def numbered(rows, *group):
    """Rows with their expected positions: by group, rows without a key last."""
    out = {}
    for g in {tuple(r[c] for c in group) for r in rows}:
        own = [r for r in rows if tuple(r[c] for c in group) == g]
        out |= {r["id"]: i for i, r in enumerate(sorted(own, key=lambda r: (r["k"] is None, r["k"] or 0)), 1)}
    return out


@pytest.mark.parametrize("group", [[], ["g"]])
def test_positions_of_sparse_keys(spark, group):
    rng = random.Random(1)
    keys = [rng.choice([-1, 1]) * rng.randrange(2**62) for _ in range(500)]
    rows = [{"id": i, "k": k, "g": rng.choice(["hot", "hot", "cold", None])} for i, k in enumerate(keys)]
    df = spark.createDataFrame([(r["id"], r["k"], r["g"]) for r in rows], "id int, k long, g string")
    for frame in (df, df.repartition(7)):
        assert {r["id"]: r["position"] for r in ordering.positions(frame, "k", group).collect()} == numbered(rows, *group)
    assert ordering.positions(df.limit(0), "k", group).collect() == []


def test_positions_of_equal_and_missing_keys(spark):
    rows = [(i, None if i % 3 == 0 else i % 5) for i in range(90)] + [(90, 1), (90, 1)]
    got = ordering.positions(spark.createDataFrame(rows, "id int, k int").repartition(3), "k").collect()
    assert sorted(r["position"] for r in got) == list(range(1, 93))
    by_place = [r["k"] for r in sorted(got, key=lambda r: r["position"])]
    assert by_place == sorted((k for k in by_place if k is not None)) + [None] * 30
    words = spark.createDataFrame([("b",), ("a",), (None,)], "k string")
    assert {r["k"]: r["position"] for r in ordering.positions(words, "k").collect()} == {"a": 1, "b": 2, None: 3}


def test_numbering_passes_no_range_of_rows_through_one_task(spark):
    plan = corpus.renumber(spark.range(10**6).selectExpr("id * 1000003 AS k"), "k")._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(single) <= 1  # one count per partition


def test_neighbours_over_ranges(spark):
    rows = [(g, i, f"{g}:{i}") for g, n in (("a", 50), ("b", 1), ("c", 8)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int, t string")
    got = ordering.neighbours(df, "i", ["g"], {"prev": ("t", -1, "-"), "next": ("t", 1, "+")}, width=4).collect()
    assert len(got) == len(rows)
    sizes = {"a": 50, "b": 1, "c": 8}
    for r in got:
        assert r["prev"] == (f"{r['g']}:{r['i'] - 1}" if r["i"] else "-")
        assert r["next"] == (f"{r['g']}:{r['i'] + 1}" if r["i"] + 1 < sizes[r["g"]] else "+")


@pytest.mark.parametrize("sizes", [{"a": 700, "b": 31, "c": 1}, {"a": 3, "b": 2}])
def test_stratified_split(spark, sizes):
    rows = [(f"{label}{i}", label) for label, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "id string, label string")
    parted = split.stratified_split(df, "label", "id", {"train": 80, "val": 10, "test": 10}, seed=5).collect()
    assert len({r["id"] for r in parted}) == len(rows)
    for label, n in sizes.items():
        ranked = sorted((i for i, x in rows if x == label), key=lambda i: hashlib.md5(f"5|{i}".encode()).hexdigest())
        cuts = [(n * 80 + 50) // 100, (n * 90 + 50) // 100]
        expected = {i: "train" if k < cuts[0] else "val" if k < cuts[1] else "test" for k, i in enumerate(ranked)}
        assert {r["id"]: r["split"] for r in parted if r["label"] == label} == expected


def test_folds(spark):
    rows = [(i, float(i % 7 == 0)) for i in range(203)]
    df = spark.createDataFrame(rows, "id int, label double")
    folds = split.stratified_folds(df, "label", "id", k=5).collect()
    for label in (0.0, 1.0):
        sizes = Counter(r["fold"] for r in folds if r["label"] == label)
        assert set(sizes) == set(range(5)) and max(sizes.values()) - min(sizes.values()) <= 1


def test_class_weights(spark):
    rows = [("low",)] * 36 + [("high",)] * 34 + [("medium",)] * 192
    df = spark.createDataFrame(rows, "label string")
    weights = {r["label"]: r["weight"] for r in split.class_weights(df, "label").collect()}
    assert {k: round(v, 4) for k, v in weights.items()} == {"low": 2.4259, "high": 2.5686, "medium": 0.4549}
    total = split.with_weights(df, "label").agg(F.sum("weight")).first()[0]
    assert abs(total - len(rows)) < 1e-9


def test_many_classes_and_a_null_class(spark):
    df = spark.range(15_000).selectExpr("id", "CASE WHEN id >= 14990 THEN NULL ELSE CAST(id % 5000 AS STRING) END AS label")
    weighted = split.with_weights(df, "label").groupBy("label").agg(F.min("weight").alias("w"), F.count("*").alias("n")).collect()
    assert len(weighted) == 5001 and all(abs(r["w"] - 15_000 / (5001 * r["n"])) < 1e-9 for r in weighted)
    parts = split.stratified_split(df, "label", "id", {"train": 80, "test": 20}).groupBy("label", "split").count().collect()
    assert {r["split"]: r["count"] for r in parts if r["label"] is None} == {"train": 8, "test": 2}
    assert sum(r["count"] for r in parts) == 15_000 and len({r["label"] for r in parts}) == 5001
    folds = split.stratified_folds(df, "label", "id").groupBy("label", "fold").count().collect()
    assert [r["count"] for r in folds if r["label"] is None] == [2] * 5 and sum(r["count"] for r in folds) == 15_000


def test_keep_first_and_renumber(spark):
    rows = [(3, "x", "b"), (1, "x", "a"), (2, "y", "c")] + [(i, "hot", "h") for i in range(10, 300)]
    df = spark.createDataFrame(rows, "message_id int, raw_text string, source string")
    kept = corpus.keep_first(df, "raw_text", ["message_id"])
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "x", "a"), (2, "y", "c"), (10, "hot", "h")]
    assert [r["row_no"] for r in corpus.renumber(kept, "message_id").orderBy("message_id").collect()] == [0, 1, 2]


def test_filter_without_target(spark):
    with_target = spark.createDataFrame([(7, "a", 1), (8, "b", 0)], "id int, text string, target int")
    assert [r["message_id"] for r in corpus.filter_messages(with_target, "s").collect()] == ["KG_00007"]
    assert corpus.filter_messages(with_target.drop("target"), "s").count() == 2


def test_history_over_ranges(spark):
    rows = [(c, i, "user" if i % 2 == 0 else "assistant", "x" * (i % 5)) for c, n in ((1, 40), (2, 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    got = {(r["conv_id"], r["turn"]): r for r in chat.history(df, width=8).collect()}
    assert len(got) == len(rows)
    for (c, i), r in got.items():
        before = [x for x in rows if x[0] == c and x[1] < i]
        assert r["history_turns"] == len(before)
        assert r["history_chars"] == sum(len(x[3]) for x in before)
        assert (r["prev_role"], r["prev_text"]) == ((before[-1][2], before[-1][3]) if before else (None, None))


def test_gate(spark):
    rows = [(1, 0, "hi"), (1, 1, "  "), (1, 2, " QUIT "), (1, 3, "more"), (2, 0, "quit it"), (2, 1, "bye now"), (3, 0, "bye")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, text string")
    assert sorted((r["conv_id"], r["turn"]) for r in chat.gate_turns(df, role=None).collect()) == [(1, 0), (2, 0), (2, 1)]
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "exit"), (1, 2, "system", "quit"), (1, 3, None, "bye"), (1, 4, "user", "Exit"), (1, 5, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    assert sorted(r["turn"] for r in chat.gate_turns(df).collect()) == [0, 1, 2, 3]


def test_prompt(spark):
    df = spark.createDataFrame([("why?",)], "q string")
    prompt = chat.grounded_prompts(df, F.lit("facts {x}"), "q", "K:\n{knowledge}\n").first()["prompt"]
    assert prompt == "K:\nfacts {x}\n\n\nUser question:\nwhy?"


def test_templates(spark):
    from corpusloom.sources.template_data import HUMAN_FILLERS, HUMAN_TEMPLATES, filler_table, template_table

    prompts = spark.createDataFrame(
        [(1, "P01", "advice", "How do I stay motivated while studying for exams?"), (2, "P13", "factual", "What is x?")],
        "prompt_no int, prompt_id string, category string, prompt string",
    )
    made = corpus.expand_templates(
        prompts, template_table(spark, HUMAN_TEMPLATES), filler_table(spark, HUMAN_FILLERS), "human", "H", per_prompt=7
    ).orderBy("response_id").collect()
    assert len(made) == 14
    assert made[0]["response_text"] == "honestly i just make tiny goals. works better than fancy plans for me."
    assert made[5]["response_text"] == made[0]["response_text"]
    assert (made[7]["response_id"], made[7]["prompt_id"]) == ("H_0008", "P13")


def test_templates_are_filled_in_one_pass(spark):
    prompts = spark.createDataFrame([(None, "P0", None, "q"), (4, "P4", "c", "q"), (9, "P9", "none", "q")], "prompt_no int, prompt_id string, category string, prompt string")
    templates = spark.createDataFrame([("c", ["{a} and {b}, {b}{a}"]), (None, ["no {b}"])], "category string, templates array<string>")
    fillers = spark.createDataFrame([("c", [("{b}", "{a}")]), (None, [("x", "$1 \\y")])], "category string, fillers array<struct<a:string,b:string>>")
    made = {r["prompt_id"]: r for r in corpus.expand_templates(prompts, templates, fillers, "human", "H", per_prompt=1).collect()}
    assert made["P4"]["response_text"] == "{b} and {a}, {a}{b}" and made["P4"]["response_id"] == "H_0001"
    assert made["P0"]["response_text"] == "no $1 \\y" and made["P0"]["response_id"] == "H_0003" and made["P9"]["response_text"] is None


def test_pivot_mean(spark):
    rows = [("pos_enc", "AdaBoost", 0.34339), ("pos_enc", "Decision Tree", 0.43766), ("pos_enc", "Random Forest", 0.20008),
            ("is_number", "Decision Tree", 0.00095), ("is_number", "Random Forest", 0.00469)]
    df = spark.createDataFrame(rows, "feature string, model string, importance double")
    wide = counting.wide_means(df, "feature", "model", "importance", ["AdaBoost", "Decision Tree", "Random Forest"]).collect()
    assert [(r["feature"], round(r["mean"], 7)) for r in wide] == [("pos_enc", 0.3270433), ("is_number", 0.00188)]
    assert wide[1]["AdaBoost"] == 0.0


def test_histogram_and_statistics(spark):
    df = spark.createDataFrame([("a", v) for v in range(61)] + [("b", 5), ("b", 5)], "g string, v int")
    bins = {(r["g"], r["bin"]): r["n"] for r in counting.histogram(df, "g", F.col("v")).collect()}
    assert bins[("a", 29)] == 3 and bins[("a", 0)] == 2 and bins[("b", 0)] == 2 and len(bins) == 31
    stats = counting.summary_statistics(df.where("g = 'a'"), ["v"]).first()
    assert (stats["n"], stats["mean"], stats["q25"], stats["q50"], stats["max"]) == (61, 30.0, 15.0, 30.0, 60)
    assert abs(stats["std"] - 17.752934) < 1e-5
    one = counting.summary_statistics(df.where("g = 'a' AND v = 7"), ["v"]).first()
    assert (one["n"], one["mean"], one["std"]) == (1, 7.0, None)


@pytest.mark.parametrize("parts", [3, 1024])
def test_exact_quantiles(spark, parts):
    import numpy as np

    rng = random.Random(parts)
    kinds = {
        "wide": lambda: rng.choice([-1, 1]) * 10.0 ** rng.uniform(-9, 12), "few": lambda: rng.choice([1.0, 1.0, 2.0, None]),
        "one": lambda: 5.0, "none": lambda: None, "odd": lambda: rng.choice([float("nan"), 1e308, -1e308, 0.0, -0.0]), "close": lambda: 1e15 + rng.randrange(3),
    }
    rows = [tuple(make() for make in kinds.values()) for _ in range(400)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in kinds))
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = counting.exact_quantiles(df.repartition(3), list(kinds), shares, parts)
    for i, c in enumerate(kinds):
        values = [r[i] for r in rows if r[i] is not None and r[i] == r[i]]
        if not values:
            assert got[c] == [None] * len(shares)
            continue
        ranked = sorted(values)
        for share, q in zip(shares, got[c]):
            low, high = ranked[int((len(ranked) - 1) * share)], ranked[int(np.ceil((len(ranked) - 1) * share))]
            assert min(low, high) <= q <= max(low, high) and (low != high or q == low)
            if abs(low) < 1e300:
                assert np.isclose(q, np.quantile(values, share), rtol=1e-12)
    stats = {r["column"]: r for r in counting.summary_statistics(df.select("close", "none", "few"), ["close", "none", "few"]).collect()}
    close = [r[5] for r in rows]
    assert abs(stats["close"]["std"] - np.std(close, ddof=1)) < 1e-6 and stats["none"]["n"] in (0, None)


def test_histogram_of_many_groups_and_a_null_group(spark):
    df = spark.range(5000).selectExpr("cast(id as string) AS g", "1 AS v").unionByName(spark.sql("SELECT cast(null as string) AS g, 2 AS v"))
    bins = counting.histogram(df, "g", F.col("v")).collect()
    assert len(bins) == 5001 and {(r["bin"], r["n"]) for r in bins} == {(0, 1)}
    assert sum(r["g"] is None for r in bins) == 1


def test_best_of(spark):
    df = spark.createDataFrame([("a", 0.5, 2), ("b", 0.7, 1), ("c", 0.7, 0)], "name string, score double, place int")
    assert counting.best_of(df, "name", "score", "place").first()["name"] == "c"


def test_first_copy_goes_by_the_number_of_the_id(spark):
    raw = spark.createDataFrame([(100000, "a text that is long enough"), (99999, "a text that is long enough")], "id long, text string")
    assert [r["message_id"] for r in flows.message_corpus(raw, "posts").collect()] == ["KG_99999"]


@pytest.mark.parametrize("limit", [0, 64])
def test_passed_cuts_shuffle_no_row(spark, monkeypatch, limit):
    monkeypatch.setattr(ordering, "MAX_STRATA", limit)
    monkeypatch.setattr(ordering, "MAX_BUCKETS", limit)
    labels = [None, float("nan"), 0.0, 1.0, 1.0, 1.0]
    rows = [(f"k{i}", labels[i % 6]) for i in range(600)]
    df = spark.createDataFrame(rows, "key string, label double")
    passed = ordering.with_passed_cuts(df, "label", "key", [F.floor(F.col("n") * 0.25), F.col("n") * 0], 7, "passed")
    got = {r["key"]: r["passed"] for r in passed.collect()}
    for own in (None, "nan", "0.0", "1.0"):
        keys = sorted((k for k, x in rows if (str(x) if x is not None else None) == own), key=lambda k: hashlib.md5(f"7|{k}".encode()).hexdigest())
        cut = len(keys) // 4
        assert [got[k] for k in keys] == [1] * cut + [2] * (len(keys) - cut)
    plan = passed._jdf.queryExecution().toString()
    assert ("Join" in plan) == (limit == 0)


def test_neighbours_and_sizes_shuffle_rows_once(spark, tmp_path):
    """Rows stay where the window has put them when sizes are joined by message and range."""
    from corpusloom.plans import token_queries

    texts = {1: " ".join(f"w{i}" for i in range(2500)), 2: "one", 3: "a b", 4: "", 5: None}
    docs = spark.createDataFrame([(i, t, "web") for i, t in texts.items()] + [(3, "a b", "web"), (None, "x y", "web")], "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = token_queries.token_neighbours(spark, str(tmp_path))
        plan = result._jdf.queryExecution().executedPlan().toString()
        rows = [tuple(r) for r in result.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    by_key = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(by_key) == 3  # token rows, partial sizes, sizes by range
    words = texts[1].split()
    own = sorted(r for r in rows if r[0] == 1)
    assert [r[2:5] for r in own] == list(zip(words, ["", *words], [*words[1:], ""]))
    assert all(abs(r[5] - round(r[1] / 2499, 4)) < 1e-9 for r in own)
    assert sorted(r for r in rows if r[0] != 1) == [
        (2, 0, "one", "", "", 0.0), (3, 0, "a", "", "a", 0.0), (3, 0, "a", "a", "b", 0.0), (3, 1, "b", "a", "b", 0.3333), (3, 1, "b", "b", "", 0.3333),
    ]
