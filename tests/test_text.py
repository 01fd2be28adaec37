import pytest
from pyspark.sql import functions as F

from corpusloom.functions import numeric, vocab
from corpusloom.functions import text as t
from corpusloom.functions.stemming import add_stems
from corpusloom.operators import tickets as tk
from corpusloom.operators import words


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw, expected", [
    ("7", "KG_00007"), ("123456", "KG_123456"), ("KG_x", "KG_x"), ("9" * 20, "KG_" + "9" * 20),
])
def test_prefixed_id(spark, raw, expected):
    assert one(spark, raw, t.prefixed_id) == expected


@pytest.mark.parametrize("raw, expected", [("Human", "human"), ("ai", "AI"), ("AI", "AI"), ("said", "sAId"), (" Human\n", "human")])
def test_normalised_label(spark, raw, expected):
    assert one(spark, raw, t.normalised_label) == expected


@pytest.mark.parametrize("raw, kept", [("0123456789", False), ("01234567890", True), ("  0123456789\t\n", False)])
def test_long_enough(spark, raw, kept):
    assert one(spark, raw, lambda c: t.long_enough(c, 10)) is kept


def test_affixes(spark):
    long = {"unhappiness": "both prefix ('un') and suffix ('ness')"}
    short = {
        "running": "suffix ('ing')", "undo": "prefix ('un')", "helpful": "suffix ('ful')", "careless": "suffix ('less')",
        "preview": "prefix ('pre')", "mismatch": "prefix ('mis')", "nation": "suffix ('tion')", "happily": "suffix ('ly')",
        "book": "neither", "unhappiness": "both ('un' + 'ness')",
    }
    for expected, is_short in ((long, False), (short, True)):
        rows = spark.createDataFrame([(w,) for w in expected], "word string")
        assert {r["word"]: r["affix_class"] for r in words.affixes(rows, is_short).collect()} == expected


def test_phrase_counts(spark):
    assert one(spark, "maybe maybe it seems fine", lambda c: t.phrase_count(c, vocab.HEDGES)) == 2
    assert one(spark, "however, also ok", lambda c: t.phrase_count(c, vocab.DISCOURSE)) == 1


@pytest.mark.parametrize("raw, expected", [("1,200.5", True), (".", False), ("12a", False), ("44", True), ("٤٤", True)])
def test_is_numeric(spark, raw, expected):
    assert one(spark, raw, t.is_numeric) is expected


@pytest.mark.parametrize("raw, expected", [
    ("", "missing"), (None, "missing"), ("your_api_key_here", "placeholder"), ("gen-lang-client-0123", "client_id"),
    ("AIza" + "x" * 31, "valid"), ("AIza" + "x" * 30, "invalid"), ("AQ." + "x" * 17, "valid"), ("abc", "invalid"),
])
def test_credential_class(spark, raw, expected):
    assert one(spark, raw, t.credential_class) == expected


def test_clean_credential(spark):
    assert one(spark, " \"'abc'\" ", t.clean_credential) == "abc"


@pytest.mark.parametrize("raw, expected", [
    (None, "ok"), ("400 API_KEY_INVALID", "bad_key"), ("429 too many", "quota"), ("404 Model not found", "model_missing"),
    ("404 page", "other"), ("boom", "other"),
])
def test_outcome_class(spark, raw, expected):
    assert one(spark, raw, t.outcome_class) == expected


def test_half_even(spark):
    for value, digits, expected in ((0.03125, 4, 0.0312), (0.15625, 4, 0.1562), (2.5, 0, 2.0), (0.33333, 4, 0.3333)):
        assert one(spark, value, lambda c: numeric.half_even(c, digits), "double") == expected


def test_softmax(spark):
    logits = spark.createDataFrame([([1.0, 3.0, 2.0],), ([1000.0, 0.0, 0.0],)], "z array<double>")
    rows = logits.select(numeric.softmax(F.col("z")).alias("p"), numeric.argmax(F.col("z")).alias("k")).collect()
    assert [r["k"] for r in rows] == [1, 0]
    assert all(abs(sum(r["p"]) - 1) < 1e-12 for r in rows)
    assert rows[1]["p"][0] == 1.0


def test_stems(spark):
    expected = {
        "running": "run", "runner": "runner", "runs": "run", "easily": "easili", "easier": "easier", "easy": "easi",
        "cats": "cat", "cat": "cat", "happier": "happier", "happiness": "happi", "unhappiness": "unhappi", "undo": "undo",
        "helpful": "help", "careless": "careless", "preview": "preview", "mismatch": "mismatch", "nation": "nation",
        "happily": "happili", "book": "book", "relational": "relat", "agreed": "agre", "hopping": "hop", "filing": "file",
        "dying": "die", "news": "news", "is": "is", "probate": "probat", "controlling": "control", "geology": "geolog",
    }
    rows = add_stems(spark.createDataFrame([(w,) for w in expected], "word string"))
    assert {r["word"]: r["stem"] for r in rows.collect()} == expected


def test_families(spark):
    text = spark.createDataFrame([("running runner runs easily easier easy cats cat happier happiness cats",)], "text string")
    found = {r["root"]: (r["members"], r["size"], r["uses"]) for r in words.stem_families(words.word_counts(text, "text")).collect()}
    assert found["run"] == (["running", "runs"], 2, 2)
    assert found["cat"] == (["cat", "cats"], 2, 3)
    assert found["easi"] == (["easy"], 1, 1)


def test_vocabulary_hits(spark):
    tokens = spark.createDataFrame([(i, "the") for i in range(500)] + [(0, "river"), (1, "x")], "m int, token string")
    vocabulary = spark.createDataFrame([("the",), ("the",), ("river",)], "word string")
    hits = words.vocabulary_hits(tokens, vocabulary, "token")
    assert sorted(hits.columns) == ["m", "token"]
    assert hits.count() == 501


def test_ticket_text(spark):
    rows = [(1, "Incident", " VPN down ", None, None), (2, None, None, None, None), (3, " ", "\t", "", " \n"), (4, None, None, None, " given ")]
    df = spark.createDataFrame(rows, "id int, type string, subject string, body string, text string")
    plain = df.select("id", t.ticket_text(F.col("type"), F.col("subject"), F.col("body")).alias("x"))
    assert {r["id"]: r["x"] for r in plain.collect()}[2] == "[]  |"
    assert {r["id"]: r["text"] for r in tk.scoring_text(df).collect()} == {1: "[Incident] VPN down |", 4: "given"}


def test_training_tickets(spark):
    rows = [("Incident", "a", "b", "en", "high"), ("Request", "a", "b", "en", "urgent"), ("Request", "a", None, "de", "low")]
    df = spark.createDataFrame(rows, "type string, subject string, body string, language string, priority string")
    kept = tk.training_tickets(df).collect()
    assert [(r["text"], r["label"]) for r in kept] == [("[Incident] a | b", 2)]


def test_requests(spark):
    body = '{"tickets":[{"type":"Incident","subject":"s","body":"b"},{"text":"given"},{}]}'
    df = spark.createDataFrame([(1, body), (2, None)], "id int, body string")
    parsed = tk.parse_requests(df, ["id"], F.col("body"))
    assert parsed.count() == 3
    assert sorted(r["text"] for r in tk.scoring_text(parsed).collect()) == ["[Incident] s | b", "given"]


def test_check_predictions(spark):
    expected = spark.createDataFrame([(1, "high"), (2, "low")], "id int, expected string")
    predicted = spark.createDataFrame([(1, "high"), (2, "high")], "id int, predicted string")
    status = {r["id"]: r["status"] for r in tk.check_predictions(predicted, expected, "id").collect()}
    assert status == {1: "CORRECT", 2: "MISMATCH"}


def test_fill_leaves_braces_of_the_values(spark):
    df = spark.createDataFrame([("say {b}", "x")], "a string, b string")
    assert df.select(t.fill("{a}, {b} and {c}", a=F.col("a"), b=F.col("b"))).first()[0] == "say {b}, x and {c}"


def test_white_space_and_marks_of_any_kind(spark):
    from corpusloom.operators import annotate as an

    rows = [(1, "  a b 　"), (2, "ने́ दिल्ली x. Y"), (3, "́ éa")]
    df = spark.createDataFrame(rows, "message_id int, raw_text string")
    got = {r[0]: r for r in df.select("message_id", t.strip(F.col("raw_text")), t.split_words(F.col("raw_text"))).collect()}
    assert got[1][1] == "a b" and got[1][2] == ["a", "b"] and got[2][2] == ["ने́", "दिल्ली", "x.", "y"]
    tokens = {}
    for r in an.tokenize(df).orderBy("message_id", "token_idx").collect():
        tokens.setdefault(r["message_id"], []).append(r["token"])
    assert tokens == {1: ["a", "b"], 2: ["ने́", "दिल्ली", "x", ".", "Y"], 3: ["́", "éa"]}
    assert [r["sentence"] for r in an.split_sentences(df.where("message_id = 2")).orderBy("sent_idx").collect()] == ["ने́ दिल्ली x.", "Y"]
