"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import random
import re
from array import array

import pytest
from pyspark.sql import Row

from corpusloom.llm import warc
from corpusloom.llm.archive import archive_pages, archived_pages
from corpusloom.llm.bpe import Encoder, pieces
from corpusloom.llm.components import components
from corpusloom.llm.exact_dedup import exact_duplicates
from corpusloom.llm.jaccard_join import Threshold, jaccard_components, shingles, subset_keys, text_shingles, word_hashes
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.quality import quality_rules
from corpusloom.llm.queries import PATTERN, RANKS, URL_RULES
from corpusloom.llm.run_index import RunIndex
from corpusloom.llm.secrets import find_secrets, fit_markov, labelled_strings, mask_secrets, masked, outside
from corpusloom.llm.substring_dedup import remove_repeated
from corpusloom.llm.tokens import decode_documents, encode_documents
from corpusloom.llm.toxicity import toxicity
from corpusloom.llm.urls import alias_edges, url_verdicts

SCHEMA = "doc_id long, text string, kept string, id string, spans int, n long, component int, score double, uid string, length int"
LABELS = "doc_id long, quality int, toxic int"
LONG = "word " * 30_000 + "x" * 50_000


@pytest.fixture(scope="module")
def odd(spark):
    texts = [(0, None), (1, ""), (2, "a b"), (2, "a b"), (None, "a b"), (None, None), (3, LONG), (4, LONG), (5, " \n\t "), (6, "A B")]
    return spark.createDataFrame([(i, t, None, "z", 1, 7, 8, 0.5, "u", 3) for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(2, 1, 0), (2, None, None), (None, 1, 1), (3, 0, 1), (99, 1, 1)], LABELS)


def operators(spark, labels):
    pages = lambda d: d.withColumnRenamed("doc_id", "page_id").withColumnRenamed("text", "url").withColumn("html", d.kept)
    return {
        "exact": exact_duplicates,
        "jaccard": jaccard_components,
        "substring": remove_repeated,
        "encode": lambda d: decode_documents(encode_documents(d, RANKS, PATTERN), RANKS, PATTERN),
        "pack": lambda d: pack_documents(d, RANKS, PATTERN),
        "secrets": lambda d: find_secrets(d, fit_markov(labelled_strings(d))),
        "mask": lambda d: mask_secrets(d, fit_markov(labelled_strings(d))),
        "quality": lambda d: quality_rules(d, labels),
        "toxicity": lambda d: toxicity(d, labels),
        "urls": lambda d: url_verdicts(pages(d), alias_edges(pages(d)), URL_RULES),
    }


NAMES = ["exact", "jaccard", "substring", "encode", "pack", "secrets", "mask", "quality", "toxicity", "urls"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_are_all_returned(spark, odd, none, labels, name):
    run = operators(spark, labels)[name]
    result = run(odd).collect()
    if name == "pack":
        assert {(r.doc_id, r.piece) for r in result if r.piece == 0} == {(i, 0) for i in (0, 1, 2, None, 3, 4, 5, 6)}
        assert sum(r.piece == 0 for r in result) == odd.count()
    else:
        assert len(result) == odd.count()
    assert run(none).collect() == []


def test_exact_duplicates_of_odd_rows(odd):
    got = {(r.doc_id, r.text_sha256[:8]): r for r in exact_duplicates(odd, keep="largest").collect()}
    by_id = {}
    for (i, _), r in got.items():
        by_id.setdefault(i, []).append(r)
    assert [r.group_size for r in by_id[0]] == [3] and by_id[0][0].keep_id == 1 and by_id[1][0].kept
    assert by_id[2][0].group_size == 3 and by_id[2][0].kept
    assert by_id[3][0].keep_id == 4 and not by_id[3][0].kept


def test_texts_that_share_a_hash_stay_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(F, "md5", lambda c: F.hex(F.lit("same")))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_duplicates(docs).collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (1, 2), 4: (4, 1)}


def test_jaccard_of_odd_rows(odd):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(odd, 3, 90).collect()}
    assert {(0, 0, 0), (1, 0, 1), (2, 1, 2), (5, 0, 5), (6, 1, 2), (4, 2, 3)} <= got


@pytest.mark.parametrize("list_rows", [4, 4096])
@pytest.mark.parametrize("percent", [70, 90])
def test_jaccard_against_all_pairs(spark, list_rows, percent):
    rng = random.Random(percent + list_rows)
    words = [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(1, 60))
        for _ in range(rng.randint(1, 9)):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own[: rng.randint(max(1, len(own) - 3), len(own))]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs, 2, percent, list_rows=list_rows).collect()}
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[i : i + 2]) for i in range(max(1, len(w) - 1))})
    root = list(range(len(texts)))
    for _ in texts:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if 100 * len(x & y) >= percent * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    assert got == {i: (len(sets[i]), root[i]) for i in range(len(texts))}


def test_subsets_meet():
    limit = Threshold(70)
    for size in range(1, 9):
        large = shingles(" ".join(f"w{i}" for i in range(size)), 1)
        for less in range(limit.least(size), size + 1):
            small = large[:less]
            assert set(subset_keys(small, limit).tolist()) & set(subset_keys(large, limit).tolist())


def test_substrings_of_odd_rows(odd):
    got = {(r.doc_id, len(r.kept)) for r in remove_repeated(odd).collect()}
    assert {(0, 0), (1, 0), (2, 3), (None, 3), (3, len(LONG)), (4, 0)} <= got


@pytest.mark.parametrize("crowd", [1, 4096])
def test_substrings_against_brute_force(spark, crowd):
    rng = random.Random(crowd)
    parts = [bytes(rng.choices(b"abc ", k=rng.randint(1, 90))).decode() for _ in range(12)]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(60)]
    ids = rng.sample(range(1000), 60)
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in remove_repeated(docs, crowd=crowd, bucket_bytes=2000).collect()}
    first = {}
    for i, text in sorted(zip(ids, texts)):
        gone = bytearray(len(text))
        for j in range(len(text) - 49):
            if first.setdefault(text[j : j + 50], i) < i:
                gone[j : j + 50] = b"\x01" * 50
        assert got[i].decode() == "".join(x for x, g in zip(text, gone) if not g)


def test_run_index_against_search():
    rng = random.Random(5)
    for width in (9, 12, 50):
        base = [bytes(rng.choices(b"ab\x00\xff", k=rng.randint(1, 60))) for _ in range(4)]
        made = {b"".join(rng.choices(base, k=rng.randint(1, 5))) for _ in range(40)}
        own = [s for s in made if len(s) >= width]
        for s, found in zip(own, RunIndex(own, width).first_occurrences(own)):
            assert found.tolist() == [next(i for i, x in enumerate(own) if s[j : j + width] in x) for j in range(len(s) - width + 1)]


def test_encoder_equals_whole_texts():
    own = Encoder(RANKS, PATTERN)
    rng = random.Random(3)
    texts = ["", " ", "  a", "a  b \n c", "a  b", "\x1c a\x1d!", "it's 'll 12a", LONG, " " * 30_000 + "y", "你好，世界" * 5_000]
    texts += ["".join(rng.choices(" \n\tab1'!é s", k=200)) for _ in range(300)]
    for text in texts:
        ids = array("I", own.encode(text)).tolist()
        assert ids == own.encoding.encode_ordinary(text)
        assert "".join(pieces(text, 50)) == text
        assert [x for p in pieces(text, 50) for x in own.encoding.encode_ordinary(p)] == ids


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, i) for i in range(100, 200)] + [(7777, 7777), (None, 3), (300, 299)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(51)) and all(found[i] == 100 for i in [*range(100, 200), 1000])
    assert found[7777] == 7777 and found[300] == 299


def test_decisions_reach_aliases(spark):
    html = '<link rel="canonical" href="{}">'
    refresh = "<META HTTP-EQUIV=refresh CONTENT='0; url={}'>"
    pages = [
        (1, "http://x.net/a", html.format("http://y.com/de/1")), (2, "http://z.net/b", refresh.format("http://x.net/a")),
        (3, "http://q.net/c?utm_source=f#top", None), (4, "http://q.net/c", html.format("http://w.org/")),
        (5, "http://q.net/c", html.format("http://v.com/de/2")), (6, None, None), (7, "x", ""),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_verdicts(frame, alias_edges(frame), URL_RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "allow"}


def test_masked_secrets(spark):
    docs = spark.createDataFrame([(1, 'x token = "abcdefgh12" y'), (2, None), (2, "plain words")], "doc_id long, text string")
    got = [r.text for r in mask_secrets(docs, fit_markov(labelled_strings(docs))).orderBy("doc_id", "text").collect()]
    assert got == ['x [SECRET]" y', None, "plain words"]


def test_every_candidate_is_scored(spark):
    rng = random.Random(2)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    rows = [("".join(rng.choices(letters + "0123456789", k=30)), True) for _ in range(2000)]
    rows += [("_".join(rng.choices(["user", "name", "count", "index", "value", "read"], k=4)), False) for _ in range(2000)]
    model = fit_markov(spark.createDataFrame(rows, "token string, is_random boolean"))
    key, access = "".join(rng.choices(letters, k=30)), "AKIA" + "Q7" * 8
    texts = [f"x {key} y", "user_name_count_index_value", f"{key}/{access}-{key}"]
    got = model.spans(texts, 12.0)
    assert got[0] == [(2, 3, 32)] and got[1] == []
    assert got[2] == [(0, 3, 31), (31, 1, 51), (51, 3, 82)]
    assert masked(texts[2], got[2], "*") == "***"
    assert outside(0, 10, [(0, 0, 2), (1, 1, 4), (6, 2, 7), (9, 0, 12)]) == [(4, 6), (7, 9)]


def test_every_document_gives_labelled_strings(spark):
    docs = spark.range(60_000).selectExpr("id AS doc_id", "concat('name_of_', id) AS text")
    assert labelled_strings(docs).count() == 60_000


def test_random_strings_score_above_identifiers(spark):
    rng = random.Random(1)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows = [("".join(rng.choices(letters, k=30)), True) for _ in range(200)]
    rows += [("_".join(rng.choices(["user", "name", "count", "index", "value", "read"], k=4)), False) for _ in range(200)]
    model = fit_markov(spark.createDataFrame(rows + [(None, True), ("é", False)], "token string, is_random boolean"))
    scores = model.scores(["".join(rng.choices(letters, k=24)) for _ in range(50)] + ["read_user_name_index"] * 50)
    assert sum(x > 0 for x in scores[:50]) >= 45 and max(scores[50:]) < 0


def test_warc_round_trip(spark, tmp_path):
    warc.register(spark)
    pages = [(1, "http://a/\r\nx", "p" * 100_000), (2, None, "p" * 100_000), (3, "u", None), (4, "u", ""), (4, "u", "é"), (None, "u", "é")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    path = f"{tmp_path}/w"
    archive_pages(frame, path, min_bytes=1)
    got = sorted(((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in archived_pages(spark, path).collect()), key=str)
    assert got == sorted([
        (1, 100_000, "response", None), (2, 100_000, "revisit", 1), (3, 0, "response", None), (4, 0, "response", None),
        (4, 2, "response", None), (0, 2, "revisit", 4),
    ], key=str)
    plain = spark.read.format("warc").schema("record_type string").load(path).where("record_type = 'revisit'")
    assert "record_type" in plain._jdf.queryExecution().toString() and plain.collect() == [Row(record_type="revisit")] * 2
    empty = f"{tmp_path}/none"
    archive_pages(frame.limit(0), empty)
    assert archived_pages(spark, empty).collect() == []


def test_plain_and_foreign_archives(spark, tmp_path):
    import gzip

    warc.register(spark)
    one = warc.record({"record_type": "response", "record_id": "<a>"}, b"x\r\n\r\nWARC/1.1\r\n" * 9000)
    two = warc.record({"record_type": "request", "record_id": "<b>"}, b"")
    (tmp_path / "a.warc").write_bytes(one + two)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    frame = spark.read.format("warc").load(str(tmp_path))
    got = sorted((r.record_id, len(r.payload)) for r in frame.collect())
    assert got == [("<a>", 9000 * 15), ("<a>", 9000 * 15), ("<b>", 0), ("<b>", 0)]
    heads = spark.read.format("warc").schema("record_id string").load(str(tmp_path)).collect()
    assert sorted(r.record_id for r in heads) == ["<a>", "<a>", "<b>", "<b>"]
    assert re.match(r"<.>", heads[0].record_id)


@pytest.mark.parametrize("width", [1, 2, 3, 5])
def test_shingles_of_many_texts_at_once(width):
    """All words of a piece are hashed together, of any length, and no shingle crosses into the next text."""
    words = ["a", "A", "a\x00", "\x00", "İ", "\x85", "ab" * 4, "ab" * 4 + "c", "b" * 32, "b" * 33, "b" * 33 + "c", "c" * 3_000_000]
    rng = random.Random(width)
    texts = ["", " \x0b\x0c", "x", "x\x1cy", *(rng.choice(" \t\n\r").join(rng.choices(words[:-1], k=rng.randrange(9))) for _ in range(300)), words[-1], ""]
    names, hashes = {}, {}
    for text, codes in zip(texts, text_shingles(texts, width), strict=True):
        own = text.encode().lower().split()
        size = min(width, len(own))
        expected = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        assert codes.tolist() == sorted(set(codes.tolist())) == shingles(text, width).tolist() and len(codes) == len(expected)
        if len(expected) == 1:
            assert names.setdefault(int(codes[0]), expected) == expected and hashes.setdefault(*expected, int(codes[0])) == codes[0]
    starts, codes = word_hashes(b" ".join(w.encode() for w in words))
    assert len(starts) == len(words) == len(set(codes.tolist()))
