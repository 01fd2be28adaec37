"""Collocations, SimHash components and whitening: brute force, odd inputs, and the parts they are made of."""

import collections
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from corpusloom.llm import packing, simhash
from corpusloom.llm.collocations import collocations
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.qdwh import leading_components
from corpusloom.llm.queries import PATTERN, RANKS, TOKENIZER
from corpusloom.llm.simhash import simhash_components
from corpusloom.llm.whitening import whitened_embeddings

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- collocations --------------------------------------------------------------------------------

def brute_collocations(rows, max_words, min_count, top):
    n, f = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    dropped = set()
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                inner = (lang, words[i : i + size])
                if 100 * a >= 50 * candidates[inner]:
                    dropped.add(inner)
    ranked = collections.defaultdict(list)
    for (lang, words), a in candidates.items():
        if (lang, words) not in dropped:
            cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
            score, _, left, right = min((1_000_000 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
            ranked[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, found in ranked.items() for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    )


def corpus(seed, rows=300):
    rng = random.Random(seed)
    words = ["a", "B", "cc", "é", "d'e", "ff", "ß", "\U0001f600"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "\x0b"]
    made = [(rng.choice(["en", "de", None]), "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(60)))) for _ in range(rows)]
    return made + [("en", None), (None, ""), ("fr", " . , "), ("hot", "x y z " * 5000)]


@pytest.mark.parametrize("max_words, budget", [(2, 400_000), (3, 400_000), (3, 20), (4, 5)])
def test_collocations_equal_brute_force(spark, max_words, budget):
    rows = corpus(max_words)
    frame = spark.createDataFrame([(lang, t, 1, 2) for lang, t in rows], "lang string, text string, n int, phrase int")
    got = collocations(frame.repartition(3), max_words, 5, 40, budget=budget).collect()
    assert sorted(map(tuple, got)) == brute_collocations(rows, max_words, 5, 40)


def test_collocations_of_nothing(spark):
    schema = "lang string, text string"
    assert collocations(spark.createDataFrame([], schema)).collect() == []
    assert collocations(spark.createDataFrame([("en", None), (None, " .\n"), ("en", "one")], schema), min_count=1).collect() == []
    with pytest.raises(ValueError):
        collocations(spark.createDataFrame([], schema), max_words=1)


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    from corpusloom.llm.collocations import exact_score

    big = 9 * 10**14 + 7
    frame = spark.createDataFrame([(big - 5, big, big - 1)], "a long, l long, r long")
    score = frame.select(exact_score(F.col("a"), F.col("l"), F.col("r"), 1_000_000).alias("s")).first().s
    assert score == 1_000_000 * (big - 5) ** 2 // (big * (big - 1))


# ---- SimHash -------------------------------------------------------------------------------------

def brute_print(text, words_each):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + words_each]).encode(), 42) for i in range(max(1, len(words) - words_each + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    """Smallest reachable id for each row of (id, print); null ids connect."""
    values = np.array([p for _, p in prints], np.uint64)
    left, found = np.ones(len(values), bool), [None] * len(values)
    for root in range(len(values)):
        if left[root]:
            group, todo, left[root] = [root], [root], False
            while todo:
                near = np.flatnonzero(left & (np.bitwise_count(values ^ values[todo.pop()]) <= distance))
                left[near] = False
                group += near.tolist()
                todo += near.tolist()
            ids = [prints[i][0] for i in group if prints[i][0] is not None]
            for i in group:
                found[i] = min(ids, default=None)
    return found


def test_simhash_query(spark):
    texts = duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall()
    prints = [(i, brute_print(t, 3)) for i, t in texts]
    expected = sorted((i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints, 3)))
    assert sorted(map(tuple, entry.queries()["op12_simhash"](spark, FOLDER).collect())) == expected


def test_simhash_of_odd_rows(spark):
    long = "word " * 30_000 + "x" * 50_000
    texts = [(0, None), (1, ""), (2, "a b"), (2, "A b"), (None, "a b"), (None, "z z z"), (3, long), (4, long), (5, " \n\t ")]
    frame = spark.createDataFrame([(i, t, 1, "f") for i, t in texts], "doc_id long, text string, component_id int, print string")
    got = simhash_components(frame).collect()
    prints = [(i, brute_print(t, 5)) for i, t in texts]
    expected = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints, 3))]
    order = lambda r: tuple(-1 if x is None else x for x in r[::2]) + (r[1],)
    assert sorted(map(tuple, got), key=order) == sorted(expected, key=order)
    assert simhash_components(frame.limit(0)).collect() == []
    with pytest.raises(ValueError):
        simhash_components(frame, distance=4)


def planted_prints(rng, size):
    """Clusters of few and many, chains at the largest distance, and equal halves."""
    prints = [0, 7, (1 << 64) - 1]
    while len(prints) < size:
        value = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 40])):
            prints.append(value)
            for _ in range(rng.randrange(5)):
                value ^= 1 << rng.randrange(64)
    prints += [prints[5] & 0xFFFFFFFF | rng.getrandbits(32) << 32 for _ in range(200)]
    return sorted(set(prints))


@pytest.mark.parametrize("distance, crowd", [(0, 1000), (1, 1000), (2, 2), (3, 1000), (3, 2), (3, 0)])
def test_no_link_is_lost(spark, distance, crowd):
    prints = planted_prints(random.Random(distance + crowd), 1500)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    cells = simhash.replicated(spark.createDataFrame([(p,) for p in signed], "print long"), crowd)
    links = cells.groupBy("cell").applyInArrow(simhash.compared(distance), "a long, b long").collect()
    place, parent = {p: i for i, p in enumerate(signed)}, list(range(len(signed)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        assert (np.int64(a) ^ np.int64(b)).view(np.uint64).item().bit_count() <= distance
        x, y = sorted((top(place[a]), top(place[b])))
        parent[y] = x
    assert [top(i) for i in range(len(signed))] == brute_components(list(enumerate(prints)), distance)


@pytest.mark.parametrize("width", [8, 16])
def test_every_point_has_one_home_and_meets_its_neighbours_there(width):
    points = np.arange(1 << width, dtype=np.uint64)
    row, anchor, home = simhash.anchors(points, width)
    assert np.bincount(row[home], minlength=len(points)).tolist() == [1] * len(points)
    at = {int(r): int(a) for r, a in zip(row[home], anchor[home])}
    reach = collections.defaultdict(set)
    for r, a in zip(row.tolist(), anchor.tolist()):
        reach[r].add(a)
    assert len(set(zip(row.tolist(), anchor.tolist()))) == len(row) and len(set(at.values())) == 1 << (width - width.bit_length() + 1)
    for point in range(0, 1 << width, 37):
        assert all(at[point ^ bit] in reach[point] for bit in [0, *(1 << b for b in range(width))])


def test_a_dense_cell_gives_a_forest():
    prints = np.array(sorted({(1 << a) | (1 << b) for a in range(64) for b in range(64)}), np.uint64)
    links = simhash.forest(prints, np.ones(len(prints), bool), 3)
    assert sum(len(a) for a, _ in links) == len(prints) - 1


# ---- packing ---------------------------------------------------------------------------------------

def test_end_marks_in_a_text_are_tokens(spark):
    from tokenizers import Tokenizer

    texts = {1: "one <|endoftext|> two", 2: "<|endoftext|>", 3: "<|endoftext|", 4: "a <|endoftext|><|endoftext|>b " * 400}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = pack_documents(frame, RANKS, PATTERN, keep_ids=True, tokenizer_path=TOKENIZER).orderBy("doc_id", "piece").collect()
    own = Tokenizer.from_file(TOKENIZER)
    for i, text in texts.items():
        assert [x for r in rows if r.doc_id == i for x in r.ids] == [*own.encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("low, high", [(200, 520), (300, 380)])
def test_evolving_beats_best_fit_on_hard_lengths(low, high):
    rng = np.random.default_rng(3)
    lengths = sorted(rng.integers(low, high, 4000).tolist(), reverse=True)
    plain = packing.Packing([], [], 1024)
    plain.best_fit(list(range(len(lengths))), lengths)
    members = packing.first_members(lengths, 1024, 4, rng)
    best = packing.evolve(members, lengths, 1024, 24, rng)[0]
    assert sorted(i for own in best.bins for i in own) == list(range(len(lengths)))
    assert best.fills == [sum(lengths[i] for i in own) for own in best.bins] and max(best.fills) <= 1024
    assert len(best.bins) < len(plain.bins)


# ---- whitening -----------------------------------------------------------------------------------

@pytest.mark.parametrize("size", [1, 2, 3, 17, 64])
@pytest.mark.parametrize("kind", ["wishart", "two values", "rank two", "diagonal", "graded"])
def test_leading_components(size, kind):
    rng = np.random.default_rng(size)
    turn = np.linalg.qr(rng.standard_normal((size, size)))[0]
    spectra = {"two values": np.repeat([5.0, 2.0], [size // 2, size - size // 2]), "graded": 10.0 ** -np.arange(size), "diagonal": np.arange(size) + 1.0}
    if kind == "wishart":
        matrix = (lambda m: m.T @ m)(rng.standard_normal((2 * size + 3, size)))
    elif kind == "rank two":
        matrix = (lambda m: m @ m.T)(rng.standard_normal((size, 2)))
    else:
        matrix = np.diag(spectra[kind]) if kind == "diagonal" else turn @ np.diag(spectra[kind]) @ turn.T
    values, vectors = leading_components(matrix, 8)
    scale = np.linalg.norm(matrix)
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:8]).max() <= 1e-13 * scale
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(vectors.shape[1])).max() <= 1e-13


def brute_whitening(vectors, components=8):
    """By id: the deviation, and the whitened values up to their sign; shares of the trace."""
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in vectors])
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1][:components], turn[:, ::-1][:, :components]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(row, sums.tolist())) for (i, _), row in zip(vectors, x.tolist())}
    white = centred @ turn / np.sqrt(values)
    return n, deviation, {i: row for (i, _), row in zip(vectors, white)}, values / (centred**2).sum() * n


def test_whitening_query(spark):
    vectors = duckdb.sql(f"select vec_id, embedding from '{FOLDER}/embeddings.parquet'").fetchall()
    n, deviation, white, shares = brute_whitening(vectors)
    rows = entry.queries()["op13_whitening"](spark, FOLDER).collect()
    assert len(rows) == 8 * n and {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1
    signs = collections.defaultdict(set)
    for r in rows:
        own = white[r.vec_id][r.component - 1]
        assert r.deviation == deviation[r.vec_id] and r.identity_error < 1e-9
        assert abs(r.explained / shares[r.component - 1] - 1) < 1e-9
        assert abs(abs(r.whitened) - abs(own)) < 1e-7
        signs[r.component].add(np.sign(r.whitened * own)) if abs(own) > 1e-3 else None
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_of_odd_vectors(spark):
    schema = "vec_id long, embedding array<double>, n string, component string, whitened int"
    inf, nan = float("inf"), float("nan")
    good = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [-2.0, 3.0]), (3, [0.0, -0.0]), (4, [1e3, 0.25])]
    bad = [(5, None), (6, [1.0, None]), (7, [nan, 1.0]), (8, [1.0, -inf]), (9, [])]
    frame = lambda rows: spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], schema)
    rows = whitened_embeddings(frame(good + bad[:4])).collect()
    assert collections.Counter(r.vec_id for r in rows) == {1: 4, None: 2, 3: 2, 4: 2}
    assert {r.n for r in rows} == {5} and max(r.identity_error for r in rows) < 1e-4
    _, deviation, _, shares = brute_whitening(good)
    assert all(r.deviation == deviation[r.vec_id] for r in rows)
    assert whitened_embeddings(frame(bad[:4])).collect() == [] and whitened_embeddings(frame([])).collect() == []
    assert whitened_embeddings(frame([(1, [0.5, 1.0])] * 3)).collect() == []  # no variance
    assert whitened_embeddings(frame(bad[4:])).collect() == []
    assert {r.component for r in whitened_embeddings(frame([(1, [0.5, 1.0]), (2, [0.25, 1.0])])).collect()} == {1}
    with pytest.raises(ValueError):
        whitened_embeddings(frame(good + bad[4:]))
    huge = whitened_embeddings(frame([(1, [1e8, 0.0]), (2, [0.0, 0.0])])).collect()
    assert {r.deviation for r in huge} == {None if (1024 * 10**8) ** 2 >= 2**63 else (1024 * 10**8) ** 2}
    with pytest.raises(Exception, match="an entry of a vector"):
        whitened_embeddings(frame([(1, [1e30, 0.0])])).collect()


def test_digest_of_an_odd_text_is_its_own():
    assert simhash.fingerprint("A b", 3) == simhash.fingerprint("a \n b ", 3) != simhash.fingerprint("b a", 3)
    assert simhash.fingerprint("", 3) == 0
