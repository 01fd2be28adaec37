import random

from pyspark.sql import functions as F

from corpusloom.functions import vocab
from corpusloom.operators import annotate as an
from corpusloom.operators import tagging as tg

TOKENS = "message_id int, tokens array<struct<token:string,pos:string,tag_:string,dep:string,lemma:string,ent_pos:int>>"


def tok(token, pos, dep="dep", tag="", ent=None, lemma=None):
    return (token, pos, tag, dep, lemma or token.lower(), ent)


def tags(spark, *messages):
    df = spark.createDataFrame(list(enumerate(messages)), TOKENS)
    rows = tg.add_bio_tags(df).orderBy("message_id").collect()
    return [[x["bio_tag"] for x in r["tokens"]] for r in rows]


def test_rules(spark):
    got = tags(
        spark,
        [tok("send", "VERB"), tok("help", "NOUN"), tok("near", "ADP"), tok("Delhi", "PROPN"), tok("bridge", "NOUN")],
        [tok("near", "ADP"), tok("quickly", "ADV")],
        [tok("Delhi", "PROPN", ent=0), tok("rescue", "VERB", "ROOT", "VB")],
        [tok("send", "VERB"), tok("boats", "NOUN", "dobj", lemma="boat")],
        [],
        [tok("New", "PROPN", ent=0), tok("Delhi", "PROPN", ent=1), tok("-", "PUNCT"), tok("7", "NUM"), tok("x", "X")],
    )
    assert got == [
        ["B-ACT", "B-ACT", "O", "B-LOC", "I-LOC"],
        ["O", "O"],
        ["B-LOC", "O"],
        ["B-ACT", "I-ACT"],
        [],
        ["B-LOC", "I-LOC", "I-LOC", "I-LOC", "O"],
    ]


WORDS = tg.SpanVocabulary()
# (applies, label), in order; the first rule that applies decides. t is a token, s the state before
# it ("", "LOC" or "ACT") and p the lemma before it.
RULES = [
    (lambda t, s, p: t["ent"] is not None, lambda t: "B-LOC" if t["ent"] == 0 else "I-LOC"),
    (lambda t, s, p: not s and p in WORDS.prepositions, lambda t: "B-LOC" if t["pos"] in vocab.PLACE_HEAD_POS else "O"),
    (
        lambda t, s, p: s == "LOC",
        lambda t: "I-LOC"
        if {t["dep"]} & set(vocab.PLACE_INNER_DEPS) or t["pos"] == "NUM" or t["lemma"] in WORDS.places or t["token"] in "-/&"
        else "O",
    ),
    (
        lambda t, s, p: t["lemma"] in WORDS.places and t["pos"] in ("NOUN", "PROPN") and t["dep"] in vocab.PLACE_WORD_DEPS,
        lambda t: "B-LOC",
    ),
    (lambda t, s, p: t["lemma"] in WORDS.actions, lambda t: "B-ACT"),
    (lambda t, s, p: (t["pos"], t["dep"]) == ("VERB", "ROOT") and t["tag"] in vocab.FINITE_TAGS, lambda t: "B-ACT"),
    (
        lambda t, s, p: s == "ACT" and t["dep"] in vocab.ACTION_INNER_DEPS and t["pos"] in vocab.ACTION_INNER_POS,
        lambda t: "I-ACT",
    ),
    (lambda t, s, p: True, lambda t: "O"),
]


def expected_tags(message):
    out = []
    for i, values in enumerate(message):
        t = dict(zip(("token", "pos", "tag", "dep", "lemma", "ent"), values))
        state = out[-1][2:] if out else ""
        before = message[i - 1][4] if i else ""
        out.append(next(label(t) for applies, label in RULES if applies(t, state, before)))
    return out


def test_random_messages(spark):
    rng = random.Random(3)
    names = ["near", "in", "bridge", "river", "send", "help", "boat", "-", "x", "7"]
    pos = ["PROPN", "NOUN", "NUM", "ADJ", "ADV", "VERB", "ADP", "PUNCT"]
    deps = ["pobj", "compound", "dobj", "nsubj", "advmod", "ROOT", "dep", "conj"]
    messages = [
        [
            tok(rng.choice(names), rng.choice(pos), rng.choice(deps), rng.choice(["VB", "VBD", "NN"]),
                rng.choice([None] * 9 + [0, 1]))
            for _ in range(n)
        ]
        for n in [0, 1, 2, 19, 20, 21, 40, 41, 400] + [rng.randrange(1, 130) for _ in range(60)]
    ]
    got = tags(spark, *messages)
    assert got == [expected_tags(m) for m in messages]
    assert all(not (b == "I-ACT" and not a.endswith("ACT")) for m in got for a, b in zip(["O"] + m, m))


def test_annotated_message(spark):
    df = spark.createDataFrame(
        [("a", "Send help near Delhi bridge. Rescue teams reached Pune University"), ("b", ""), ("c", None)],
        "message_id string, raw_text string",
    )
    tagged = tg.tag_corpus(df)
    rows = {r["token"]: r for r in tg.bio_tokens(tagged).collect()}
    assert {k: v["bio_tag"] for k, v in rows.items()} == {
        "Send": "B-ACT", "help": "B-ACT", "near": "O", "Delhi": "B-LOC", "bridge": "I-LOC", ".": "O", "Rescue": "B-ACT",
        "teams": "I-ACT", "reached": "O", "Pune": "B-LOC", "University": "I-LOC",
    }
    assert rows["teams"]["sent_idx"] == 1 and rows["teams"]["head_idx"] == 6
    lists = {r["message_id"]: r for r in tg.token_lists(tagged).collect()}
    assert lists["a"]["loc_tokens"] == ["Delhi", "bridge", "Pune", "University"]
    assert lists["b"]["loc_tokens"] == [] and lists["c"]["act_tokens"] == []
    no_org = tg.bio_tokens(tg.tag_corpus(df, tg.SpanVocabulary(entity_types=vocab.SCORING_ENTITY_TYPES))).collect()
    assert {r["token"]: r["is_ent"] for r in no_org}["Pune"] == 0


def test_truncation_and_long_text(spark):
    text = "word " * 2000
    df = spark.createDataFrame([("a", text)], "message_id string, raw_text string")
    whole = an.annotate(df).select(F.size("sentences").alias("s"), F.size(F.flatten("sentences")).alias("n")).first()
    assert (whole["s"], whole["n"]) == (1, 2000)
    cut = an.annotate(df, max_chars=500).select(F.size(F.flatten("sentences")).alias("n")).first()
    assert cut["n"] == 100


def test_long_sentences_stay_whole(spark):
    """Heads and entities are found across any distance; only one sentence comes out."""
    names = ["Delhi"] * 1300
    words = ["we", "send"] + ["boats"] * 2000 + names + ["north"] * 1700
    rows = an.annotate(spark.createDataFrame([(1, " ".join(words)), (2, "")], "message_id int, raw_text string")).collect()
    got = {r.message_id: r.sentences for r in rows}
    assert got[2] == []
    assert len(got[1]) == 1 and len(got[1][0]) == len(words)
    tokens = got[1][0]
    assert [i + t.head_off for i, t in enumerate(tokens)] == [1] * len(words)
    assert [t.ent_pos for t in tokens] == [None] * 2002 + list(range(1300)) + [None] * 1700


def test_only_what_fields_read_is_looked_for(spark):
    df = spark.createDataFrame([(1, "We saw Delhi Police go to Pune. Rain.")], "message_id int, raw_text string")
    plan = an.annotate(df, fields=["token", "pos"])._jdf.queryExecution().optimizedPlan().toString()
    assert "PROPN" in plan and "array_repeat" not in plan and "array_max" not in plan
    text = "He saw " + "Delhi Police near " * 700 + "Pune go ."
    found = an.annotate(spark.createDataFrame([(1, text)], "message_id int, raw_text string"), fields=an.SENTENCE_FIELDS)
    toks = [t for s in found.first()["sentences"] for t in s]
    first, verb, start = next(i for i, t in enumerate(toks) if t["pos"] == "VERB"), None, None
    for i, t in enumerate(toks):
        assert t["head_off"] == (0 if i == first else (first if verb is None else verb) - i)
        verb = i if t["pos"] == "VERB" else verb
        start = (i if start is None else start) if t["pos"] == "PROPN" else None
        assert t["ent_pos"] == (None if start is None else i - start)
        assert t["ent_type"] == (None if start is None else "GPE" if t["token"] == "Pune" else "ORG")
