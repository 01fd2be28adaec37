import random

from pyspark.sql import functions as F

from corpusloom.functions import vocab
from corpusloom.operators import annotate as an
from corpusloom.operators import features as ft
from corpusloom.operators import tagging as tg

SENTENCE = "id int, s array<struct<head_off:int>>"


def depth_by_walking(heads):
    roots = [i for i, h in enumerate(heads) if h == i]
    if not roots:
        return None

    def below(i):
        return 1 + max([below(j) for j, h in enumerate(heads) if h == i and j != i], default=0)

    return below(roots[0])


def random_tree(rng, n, roots):
    order = list(range(n))
    rng.shuffle(order)
    heads = [0] * n
    for k, i in enumerate(order):
        heads[i] = i if k < roots else rng.choice(order[:k])
    return heads


def test_tree_depth(spark):
    rng = random.Random(2)
    trees = [[0], [0, 0], list(range(0, 1)) + list(range(0, 39))] + [random_tree(rng, rng.randrange(2, 60), rng.choice([1, 1, 2, 3])) for _ in range(50)]
    df = spark.createDataFrame([(k, [(h - i,) for i, h in enumerate(t)]) for k, t in enumerate(trees)], SENTENCE)
    got = {r["id"]: r["d"] for r in df.select("id", ft.sentence_depth(F.col("s")).alias("d")).collect()}
    assert got == {k: depth_by_walking(t) for k, t in enumerate(trees)}


def tagged(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "message_id int, raw_text string")
    return tg.tag_corpus(df)


def test_token_features(spark):
    corpus = tagged(spark, "help", "Send 1,200 boats near Delhi")
    encoders = ft.fit_encoders(tg.bio_tokens(corpus))
    codes = {(r["kind"], r["value"]): r["code"] for r in encoders.collect()}
    seen = sorted(set(vocab.SEED_POS))
    assert [codes[("pos", v)] for v in seen] == list(range(len(seen)))
    rows = {(r["message_id"], r["token_idx"]): r for r in ft.token_features(corpus, ft.encoder_maps(encoders)).collect()}
    assert (rows[0, 0]["token_pos_norm"], rows[0, 0]["sentence_len"]) == (0.0, 0.02)
    first, last = rows[1, 0], rows[1, 6]
    assert first["is_act_verb"] == 1 and first["is_capitalized"] == 1 and first["prev_pos_enc"] == codes[("pos", "X")]
    assert last["prev_is_prep"] == 1 and last["is_ent"] == 1 and last["next_pos_enc"] == codes[("pos", "X")]
    assert rows[1, 1]["is_number"] == 1 and rows[1, 2]["is_number"] == 0
    assert rows[1, 1]["token_pos_norm"] == 0.1667 and first["bio_enc"] == codes[("bio", "B-ACT")]


def test_unknown_value(spark):
    encoders = ft.fit_encoders(tg.bio_tokens(tagged(spark, "help")))
    other = tagged(spark, "we go")
    rows = ft.token_features(other, ft.encoder_maps(encoders)).collect()
    assert rows[0]["pos_enc"] == 0
    marked = ft.token_features(other, ft.encoder_maps(encoders), unknown=-1).collect()
    assert marked[0]["pos_enc"] == -1


def style(spark, text):
    df = spark.createDataFrame([(1, text)], "id int, response_text string")
    return ft.style_features(an.annotate(df, "response_text")).first()


def test_style_features(spark):
    row = style(spark, "Maybe it was needed. However the old boats were moved, also slowly!")
    assert (row["num_sentences"], row["num_words"]) == (2, 12)
    assert row["avg_sentence_length"] == 6.0
    assert (row["hedge_count"], row["discourse_count"]) == (1, 2)
    assert row["passive_ratio"] == 1.0
    assert row["punct_ratio"] == 3 / 15
    assert row["type_token_ratio"] == 11 / 12
    assert row["pct_adv"] == 1 / 12
    assert row["avg_word_length"] == sum(map(len, "Maybe it was needed However the old boats were moved also slowly".split())) / 12


def test_style_of_nothing(spark):
    for text in ("", None, "..."):
        row = style(spark, text)
        assert row["num_words"] == 0 and row["num_sentences"] == 1
        assert all(row[c] == 0 for c in ft.STYLE_FEATURES if c not in ("num_sentences", "punct_ratio", "parse_tree_depth"))
