"""Sentence breaks with abbreviations learnt from the texts."""

import math
import random
import re
from collections import Counter

from corpusloom.operators import sentences as se

TITLES, WORDS = ["Dr", "Mr", "e.g", "approx"], ["boats", "water", "is", "was", "left", "bridge", "rising", "help", "near", "safe"]


def corpus(seed, size):
    rng = random.Random(seed)
    texts, expected = [], []
    for _ in range(size):
        sents = []
        for _ in range(rng.randrange(1, 6)):
            words = [rng.choice(WORDS).capitalize()] + [rng.choice(WORDS) for _ in range(rng.randrange(2, 9))]
            if rng.random() < 0.5:
                words.insert(rng.randrange(1, len(words)), f"{rng.choice(TITLES)}. {rng.choice(['Rao', 'Sen'])}")
            sents.append(" ".join(words) + rng.choice([".", ".", "!", "?"]))
        texts.append(rng.choice([" ", "\n", "  "]).join(sents))
        expected.append(sents)
    return texts, expected


def plain_scores(texts):
    n, stops = Counter(), Counter()
    for text in texts:
        for m in re.finditer(r"[^\W\d_]+(?:\.[^\W\d_]+)*\.?", text.lower()):
            word = m[0].rstrip(".")
            n[word] += 1
            stops[word] += m[0].endswith(".")
    p = sum(stops.values()) / sum(n.values())
    out = {}
    for word, k in stops.items():
        if k:
            rest, letters = n[word] - k, len(word.replace(".", ""))
            ratio = 2 * (k * math.log(0.99) + rest * math.log(0.01) - k * math.log(p) - rest * math.log(1 - p))
            out[word] = (n[word], k, ratio * math.exp(-letters) * (1 + word.count(".")) * letters ** -float(rest))
    return out


def test_abbreviations_are_learnt_and_do_not_end_sentences(spark):
    texts, expected = corpus(1, 400)
    frame = spark.createDataFrame(list(enumerate(texts)), "message_id int, raw_text string").repartition(4)
    scores = se.abbreviation_scores(frame)
    got = {r["word"]: r for r in scores.collect()}
    plain = plain_scores(texts)
    assert {w: (r["n"], r["n_stop"]) for w, r in got.items()} == {w: x[:2] for w, x in plain.items()}
    assert all(math.isclose(r["score"], plain[w][2], rel_tol=1e-9, abs_tol=1e-300) for w, r in got.items())
    found = se.abbreviations(scores)
    assert {r["word"] for r in found.collect()} == {x.lower() for x in TITLES}
    split = {}
    for r in se.learnt_sentences(frame, found).collect():
        split.setdefault(r["message_id"], {})[r["sent_idx"]] = r["sentence"]
    assert all([split[i][k].rstrip() for k in sorted(split[i])] == sents for i, sents in enumerate(expected))


def test_odd_texts(spark):
    known = spark.createDataFrame([("dr",), ("e.g",), ("dr",)], "word string")
    texts = [None, "", " \n ", "Dr.", "Dr. Rao came. He left", "No stop", "See e.g. this... Or that?! Yes", "adr. Rao", "a\u0001b", "Dr.  Dr. x"]
    frame = spark.createDataFrame(list(enumerate(texts)), "message_id int, raw_text string")
    got = {}
    for r in se.learnt_sentences(frame, known).orderBy("message_id", "sent_idx").collect():
        got.setdefault(r["message_id"], []).append(r["sentence"])
    assert got == {3: ["Dr."], 4: ["Dr. Rao came.", "He left"], 5: ["No stop"], 6: ["See e.g. this...", "Or that?!", "Yes"],
                   7: ["adr.", "Rao"], 8: ["a", "b"], 9: ["Dr.  Dr. x"]}
    assert se.abbreviation_scores(frame.limit(0)).collect() == []
