"""The learnt tagger against plain counting and all paths."""

import itertools
import math
import random

import numpy as np
import pytest

from corpusloom.operators import sequence


def score(n, total, kinds):
    x = math.log((n + 1) / (total + kinds)) * 1_000_000
    return -math.floor(-x + 0.5) if x < 0 else math.floor(x + 0.5)


def klass(word):
    return "#" if any(c.isdigit() for c in word) else "." if not any(c.isalpha() for c in word) else "-" + word[-2:]


class Plain:
    """Dictionaries of counts, and the best of all paths."""

    def __init__(self, sentences, least=2):
        labelled = [("" if i == 0 else s[i - 1][1], tag, word.lower()) for s in sentences for i, (word, tag) in enumerate(s)]
        self.tags = sorted({t for _, t, _ in labelled})
        count = lambda test: sum(map(test, labelled))
        self.sums = {t: count(lambda x: x[1] == t) for t in self.tags}
        self.trans = {(b, t): score(count(lambda x: x[:2] == (b, t)), count(lambda x: x[0] == b), len(self.tags)) for b in [*self.tags, ""] for t in self.tags}
        words = {w for _, _, w in labelled}
        known = {w for w in words if count(lambda x: x[2] == w) >= least}
        kinds = {klass(w) for w in words}
        self.words = {w: [score(count(lambda x: x[1:] == (t, w)), self.sums[t], len(known)) for t in self.tags] for w in known}
        self.classes = {c: [score(count(lambda x: x[1] == t and klass(x[2]) == c), self.sums[t], len(kinds)) for t in self.tags] for c in kinds}
        self.unseen = [score(0, self.sums[t], len(kinds)) for t in self.tags]

    def emission(self, word):
        word = word.lower()
        return self.words.get(word) or self.classes.get(klass(word)) or self.unseen

    def value(self, words, path):
        places = [self.tags.index(t) for t in path]
        return sum(self.trans[b, t] for b, t in zip(["", *path], path)) + sum(self.emission(w)[p] for w, p in zip(words, places))


def corpus(seed, size):
    rng = random.Random(seed)
    kinds = {"D": ["the", "a"], "N": ["dog", "Cat", "walks", "tree9"], "V": ["walks", "sees", "runs"], "P": ["."]}
    shapes = ["DNVP", "DNVDNP", "NVP", "V", "DN"]
    return [[(rng.choice(kinds[t]) if rng.random() < 0.9 else f"w{rng.randrange(50)}ed", t) for t in rng.choice(shapes)] for _ in range(size)]


def frame(spark, messages):
    rows = [(i, [[{"token": w, "pos": t} for w, t in s] for s in sents]) for i, sents in enumerate(messages)]
    return spark.createDataFrame(rows, "message_id int, sentences array<array<struct<token:string,pos:string>>>")


def test_tagger_finds_the_best_of_all_paths(spark):
    train, test = corpus(1, 120), corpus(2, 40)
    plain = Plain(train)
    tagger = sequence.fit_tagger(sequence.labelled_words(frame(spark, [train[:70], train[70:]]).repartition(3)))
    assert tagger.tags == plain.tags
    assert tagger.transitions.tolist() == [[plain.trans[b, t] for t in plain.tags] for b in [*plain.tags, ""]]
    assert {r["word"]: r["scores"] for r in tagger.words.collect()} == plain.words
    assert {r["class"]: r["scores"] for r in tagger.classes.collect()} == plain.classes and tagger.unseen == plain.unseen
    messages = [test[:20], [], test[20:], [[]], [[("§%", "X")]]]
    got = {r["message_id"]: r["tags"] for r in sequence.tag_sentences(frame(spark, messages), tagger).collect()}
    assert len(got) == 5 and got[1] == [] and got[3] == [[]]
    for i, sents in enumerate(messages):
        for s, tags in zip(sents, got[i]):
            words = [w for w, _ in s]
            if 0 < len(words) <= 6:
                assert plain.value(words, tags) == max(plain.value(words, p) for p in itertools.product(plain.tags, repeat=len(words)))
    right = sum(t == y for i in (0, 2) for s, tags in zip(messages[i], got[i]) for (_, t), y in zip(s, tags))
    assert right >= 0.9 * sum(len(s) for i in (0, 2) for s in messages[i])


def test_long_sentence_and_ties():
    rng = np.random.default_rng(1)
    emissions, transitions = rng.integers(-9, 0, (20_000, 5)), rng.integers(-9, 0, (6, 5))
    path = sequence.best_path(emissions, transitions)
    value = transitions[-1][path[0]] + emissions[np.arange(len(path)), path].sum() + transitions[path[:-1], path[1:]].sum()
    score = transitions[-1] + emissions[0]
    for e in emissions[1:]:
        score = (score[:, None] + transitions[:-1]).max(0) + e
    assert value == score.max()
    assert sequence.best_path(np.zeros((3, 2), int), np.zeros((3, 2), int)).tolist() == [0, 0, 0]


def test_nothing_to_learn_from(spark):
    tagger = sequence.fit_tagger(sequence.labelled_words(frame(spark, [[]])))
    got = sequence.tag_sentences(frame(spark, [[[("a", "X"), ("b", "Y")]]]), tagger).first()["tags"]
    assert got == [[None, None]]


def test_too_many_tags(spark, monkeypatch):
    monkeypatch.setattr(sequence, "MAX_TAGS", 2)
    with pytest.raises(ValueError):
        sequence.fit_tagger(sequence.labelled_words(frame(spark, [corpus(1, 20)])))
