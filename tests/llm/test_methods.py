"""What the dealt methods find: links of pages, decisions over random graphs, toxic rows that the model has not seen."""

import os
import random
from urllib.parse import urljoin

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm.toxicity import fit_toxicity, sparse_vectors, toxicity
from corpusloom.llm.urls import alias_edges, resolved, url_verdicts

FOLDER = "/root/testdata/sf0.1"


def test_links_are_resolved_like_a_browser_does(spark):
    pages = ["http://h.org", "http://h.org/", "https://h.org/a/b", "https://h.org/a/b/?q=1#x"]
    targets = ["c", "./c", "../c?x=1", "../../../c", "/d/./e/../f", "//k.org/z", "?q=2", "http://k.org/y", "c/..", "a/b:c", "."]
    rows = [(p, t) for p in pages for t in targets]
    frame = spark.createDataFrame(rows, "page string, target string")
    got = frame.select("page", "target", resolved(F.col("target"), F.col("page")).alias("full")).collect()
    # a page without a path is its site's root
    assert {(r.page, r.target): r.full for r in got} == {(p, t): urljoin("http://h.org/" if p == "http://h.org" else p, t) for p, t in rows}
    odd = [("x", "c"), ("http://h.org/", ""), ("http://h.org/", "#top"), ("http://h.org/", "mailto:a@b.org"), (None, "c"), ("http://h.org/", None)]
    frame = spark.createDataFrame(odd, "page string, target string")
    assert [r[0] for r in frame.select(resolved(F.col("target"), F.col("page"))).collect()] == [None] * len(odd)


def test_every_link_of_a_page_counts(spark):
    html = (
        '<link rel=canonical href="/one?a=1&amp;b=2"><LINK href=\'two\' rel="canonical">'
        '<meta http-equiv="refresh" content="0; url=http://k.org/3"><meta http-equiv=refresh content="1; url=../four&#38;x">'
    )
    pages = spark.createDataFrame([("http://h.org/p/q", html), ("http://n.org/", None)], "url string, html string")
    sent = spark.createDataFrame([("http://n.org/", "/five"), (None, "/six"), ("http://n.org/", None)], "source string, target string")
    got = {(r.a, r.b) for r in alias_edges(pages, redirects=sent).collect()}
    own = "http://h.org/p/q"
    assert got == {
        (own, "http://h.org/one?a=1&b=2"), (own, "http://h.org/p/two"), (own, "http://k.org/3"), (own, "http://h.org/four&x"),
        ("http://n.org/", "http://n.org/five"),
    }
    assert alias_edges(pages.limit(0), redirects=sent.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_decisions_over_random_graphs(spark, seed):
    rng = random.Random(seed)
    rules = [("allow", "good.org", "/"), ("block", "bad.org", "/"), ("block", "good.org", "/not/")]
    urls = [f"http://s{i}.net/{i}" for i in range(300)] + ["http://good.org/a", "http://bad.org/b", "http://x.bad.org/c", "http://good.org/not/d"]
    edges = [tuple(rng.sample(urls[:300], 2)) for _ in range(200)]
    edges += [(rng.choice(urls[:300]), end) for end in urls[300:] for _ in range(12)]
    parent = {u: u for u in urls}

    def root(u):
        while parent[u] != u:
            u = parent[u]
        return u

    for a, b in edges:
        parent[root(a)] = root(b)
    own = {urls[300]: "allow", urls[301]: "block", urls[302]: "block", urls[303]: "block"}
    ends: dict[str, set] = {}
    for u, verdict in own.items():
        ends.setdefault(root(u), set()).add(verdict)
    expected = {}
    for i, u in enumerate(urls):
        spread = ends.get(root(u), {"allow"})
        expected[i] = own.get(u) or ("allow" if "allow" in spread else "block")
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    linked = spark.createDataFrame([e if rng.random() < 0.5 else e[::-1] for e in edges], "a string, b string")
    got = {r.page_id: r.verdict for r in url_verdicts(pages, linked, rules).collect()}
    assert got == expected and {"allow", "block"} == set(expected.values())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_toxic_rows_not_seen_are_found(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    rows = toxicity(docs, labels).where("held_out").join(labels.select("doc_id", "toxic"), "doc_id").collect()
    toxic, other = ([r for r in rows if r.toxic == y] for y in (1, 0))
    hits, false = sum(r.predicted for r in toxic), sum(r.predicted for r in other)
    assert len(toxic) > 50 and hits >= 0.8 * len(toxic) and hits >= 0.9 * (hits + false)
    above = sum((t.score > o.score) + (t.score == o.score) / 2 for t in toxic for o in other)
    assert above >= 0.98 * len(toxic) * len(other)


def test_one_part_with_all_toxic_rows_leaves_the_bias(spark):
    rows = [(1, "awful nasty words here", 1)] + [(i, f"plain words number {i}", 0) for i in range(2, 30)]
    model = fit_toxicity(spark.createDataFrame(rows, "doc_id long, text string, toxic int"), min_rows=1)
    toxic, plain = model.scores(["awful nasty words here", "plain words number 7"])
    assert toxic > 0.5 > plain


def test_sparse_vectors_need_no_python_function(spark):
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(1.0, [0, 3], [0.5, -1.0]), (0.0, [], [])], "y double, at array<int>, x array<double>")
    made = sparse_vectors(rows, 5)
    assert {r.y: r.x for r in made.collect()} == {1.0: Vectors.sparse(5, [0, 3], [0.5, -1.0]), 0.0: Vectors.sparse(5, [], [])}
    assert "BatchEvalPython" not in made._jdf.queryExecution().toString()


def test_pairs_of_texts_and_ngrams_are_distinct_and_sorted():
    from corpusloom.llm.char_ngrams import distinct

    rng = random.Random(5)
    values = [rng.randrange(-50, 50) << 40 for _ in range(400)]
    assert distinct(np.array(values, np.int64)).tolist() == sorted(set(values)) and distinct(np.empty(0, np.int64)).tolist() == []
