"""Euclidean silhouettes against all pairs."""

import numpy as np
import pytest

from corpusloom.operators.clustering import euclidean_silhouette_rows


def plain(points, labels):
    far = np.sqrt(((points[:, None] - points) ** 2).sum(axis=2))
    out = []
    for i, label in enumerate(labels):
        own = (labels == label) & (np.arange(len(labels)) != i)
        others = [far[i][labels == c].mean() for c in set(labels) - {label}]
        out.append((min(others) - far[i][own].mean()) / max(min(others), far[i][own].mean()) if own.any() and others else 0.0)
    return np.array(out)


@pytest.fixture(scope="module")
def case(spark):
    rng = np.random.default_rng(5)
    labels = np.array([0] * 400 + [1] * 300 + [2] * 40 + [3])
    points = rng.normal(size=(len(labels), 6)) + 1.5 * labels[:, None] * rng.normal(size=6)
    points[7] = points[3]
    rows = [(i, [float(v) for v in x], int(c)) for i, (x, c) in enumerate(zip(points, labels))]
    return spark.createDataFrame(rows, "i long, v array<double>, c int"), plain(points, labels)


def test_all_rows_as_references_give_the_exact_value(case):
    frame, expected = case
    got = {r.i: r for r in euclidean_silhouette_rows(frame, "i", "v", "c", references=1000).collect()}
    assert all(abs(got[i].silhouette - s) < 1e-6 and got[i].margin == 0 for i, s in enumerate(expected))


def test_an_estimate_keeps_within_its_margin(case):
    frame, expected = case
    got = {r.i: r for r in euclidean_silhouette_rows(frame, "i", "v", "c", references=60).collect()}
    inside = [abs(got[i].silhouette - s) <= got[i].margin + 1e-9 for i, s in enumerate(expected)]
    assert np.mean(inside) >= 0.9 and abs(np.mean([got[i].silhouette for i in got]) - expected.mean()) < 0.03
    assert 0 < max(r.margin for r in got.values()) < 0.5


def test_odd_rows(spark, case):
    odd = spark.createDataFrame([(1, [0.0, 1.0], 0), (2, None, 0), (3, [1.0, 1.0], None), (None, [1.0, 2.0], 0)], "i long, v array<double>, c int")
    got = {r.i: (r.silhouette, r.margin) for r in euclidean_silhouette_rows(odd, "i", "v", "c").collect()}
    assert got == {1: (0.0, 0.0), 2: (None, None), 3: (None, None), None: (None, None)}
    assert euclidean_silhouette_rows(odd.limit(0), "i", "v", "c").count() == 0
    with pytest.raises(ValueError):
        euclidean_silhouette_rows(case[0], "i", "v", "c", references=50, max_values=600)
