"""Tree ensembles on distinct binned rows against plain versions on single rows."""

import random

import numpy as np
import pytest

from corpusloom.operators import trees as tr

FEATURES = ["a", "b", "c"]


def made(rows=600, classes=3, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        a, b, c = rng.randrange(5), rng.randrange(3), round(rng.random(), 2)
        y = (a * b + (c > 0.6)) % classes if rng.random() < 0.85 else rng.randrange(classes)
        out.append((i, a, b, c, float(y), i % 3))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(made(), "id long, a int, b int, c double, label double, fold int")


def plain_tree(x, y, weight, depth, leaf, classes):
    """Nested (feature, bin, left, right) or the sums of the classes, from every single row."""
    sums = np.array([weight[y == k].sum() for k in range(classes)])
    purity = lambda s: (s * s).sum() / s.sum() if s.sum() else 0.0
    best = None
    for f in range(x.shape[1]) if depth else ():
        for b in range(int(x[:, f].max())):
            side = x[:, f] <= b
            if min(side.sum(), (~side).sum()) >= leaf:
                parts = [np.array([weight[s & (y == k)].sum() for k in range(classes)]) for s in (side, ~side)]
                score = purity(parts[0]) + purity(parts[1])
                if score > purity(sums) * (1 + 1e-9) and (best is None or score > best[0] * (1 + 1e-12)):
                    best = (score, f, b, side)
    if best is None:
        return sums
    _, f, b, side = best
    return (f, b, *(plain_tree(x[s], y[s], weight[s], depth - 1, leaf, classes) for s in (side, ~side)))


def nested(tree, at=0):
    if tree.feature[at] < 0:
        return np.array(tree.value[at])
    return (tree.feature[at], tree.bin[at], nested(tree, tree.left[at]), nested(tree, tree.left[at] + 1))


def same(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    return a[:2] == b[:2] and same(a[2], b[2]) and same(a[3], b[3]) if isinstance(a, tuple) else np.allclose(a, b)


@pytest.mark.parametrize("depth, leaf, balance", [(1, 1, 0), (3, 4, 1), (12, 3, 2), (6, 40, 2)])
def test_a_tree_on_counted_rows_equals_one_on_single_rows(depth, leaf, balance):
    rows = np.array([(a, b, int(c * 10), y) for _, a, b, c, y, _ in made(1500)], int)
    x, y = rows[:, :3], rows[:, 3]
    held, n = np.unique(rows, axis=0, return_counts=True)
    spec = tr.decision_tree(depth, leaf, balance)
    tree, = tr.grown(spec, 0, held[:, :3], held[:, 3], n, 3)
    weight = tr.class_weight(y, np.ones(len(y), int), 3, balance)
    assert same(nested(tree), plain_tree(x, y, weight, depth, leaf, 3))


def test_boosting_on_counted_rows_equals_boosting_on_single_rows():
    rows = np.array([(a, b, int(c * 10), y) for _, a, b, c, y, _ in made(900)], int)
    held, n = np.unique(rows, axis=0, return_counts=True)
    spec = tr.ada_boost(12, 2)
    counted = list(tr.grown(spec, 0, held[:, :3], held[:, 3], n, 3))
    single = list(tr.grown(spec, 0, rows[:, :3], rows[:, 3], np.ones(len(rows), int), 3))
    assert 8 <= len(counted) == len(single) <= 12
    for a, b in zip(counted, single):
        assert np.isclose(a.alpha, b.alpha) and same(nested(a), nested(b))


def test_bins(spark, frame):
    edges = tr.bin_edges(frame, FEATURES, max_bins=8)
    assert edges[:2] == [[0, 1, 2, 3], [0, 1]] and len(edges[2]) == 7
    got = frame.select("*", tr.bins(FEATURES, edges).alias("x")).select("*", "x.*").collect()
    assert all((r.b0, r.b1, r.b2) == (r.a, r.b, sum(r.c > e for e in edges[2])) for r in got)
    sizes = np.bincount([r.b2 for r in got])
    assert len(sizes) == 8 and sizes.max() <= 2 * sizes.min()
    constant = spark.createDataFrame([(1.0,), (1.0,)], "a double")
    assert tr.bin_edges(constant, ["a"]) == [[]]


SPECS = {
    "tree": tr.decision_tree(6, 2, 1), "forest": tr.random_forest(25, 6, 2, 1), "boosted": tr.ada_boost(20, 2),
}


@pytest.fixture(scope="module")
def joint(frame):
    return tr.fit_jointly(frame, SPECS, FEATURES)


def walked(model, row):
    """The scores of one row by walking every tree from its root."""
    binned, total = [sum(row[f] > e for e in own) for f, own in zip(model.features, model.edges)], 0
    for (_, t), vote in zip(model.trees.iterrows(), model.votes()):
        at = 0
        while t.feature[at] >= 0:
            at = t.left[at] + (binned[t.feature[at]] > t.bin[at])
        total = total + vote[at]
    return total


@pytest.mark.parametrize("name", list(SPECS))
def test_scores_and_nodes(spark, frame, joint, name, tmp_path):
    model = joint.model(name)
    assert len(model.trees) == SPECS[name].trees
    rows = model.transform(frame).collect()
    assert all(r.prediction == model.labels[int(np.argmax(walked(model, r)))] for r in rows)
    assert sum(r.prediction == r.label for r in rows) > 0.6 * len(rows)
    assert abs(sum(model.featureImportances) - 1) < 1e-9 and min(model.featureImportances) >= 0
    nodes = model.nodes(spark).collect()
    assert {r.tree for r in nodes} == set(range(SPECS[name].trees)) and len(nodes) == sum(map(len, model.trees["left"]))
    assert all((r.feature is None) == (r.left == -1) for r in nodes)
    model.save(spark, str(tmp_path / "model"))
    loaded = tr.EnsembleModel.load(spark, str(tmp_path / "model"))
    assert loaded.spec == model.spec
    assert [r.prediction for r in loaded.transform(frame).collect()] == [r.prediction for r in rows]
    counts = {(r.label, r.prediction): r.n for r in tr.scored_cells(frame, {name: model}).groupBy("label", "prediction").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert sum(counts.values()) == len(rows)
    assert all(n == sum(r.label == y and r.prediction == p for r in rows) for (y, p), n in counts.items())


def test_a_joint_fit_does_not_depend_on_partitions(frame, joint):
    again = tr.fit_jointly(frame.repartition(7), SPECS, FEATURES)
    for name in SPECS:
        a, b = joint.model(name), again.model(name)
        assert a.edges == b.edges and all(np.array_equal(x, y) for x, y in zip(a.trees["bin"], b.trees["bin"]))


def test_folds_are_fitted_on_the_others(frame):
    scores = tr.cross_validated(frame, SPECS, FEATURES, folds=3).collect()
    assert {(r.model, r.fold) for r in scores} == {(m, f) for m in SPECS for f in range(3)}
    alone = tr.fit_jointly(frame.where("fold <> 1"), {"tree": SPECS["tree"]}, FEATURES, edges=tr.bin_edges(frame, FEATURES))
    rows = alone.model("tree").transform(frame.where("fold = 1")).collect()
    f1 = []
    for k in {r.label for r in rows} | {r.prediction for r in rows}:
        hit, y, p = (sum(t) for t in ([r.label == r.prediction == k for r in rows], [r.label == k for r in rows], [r.prediction == k for r in rows]))
        f1.append(2 * hit / (y + p))
    assert abs(next(r.score for r in scores if (r.model, r.fold) == ("tree", 1)) - sum(f1) / len(f1)) < 1e-9


def test_logistic_boosting(frame):
    two = frame.selectExpr("id", "a", "b", "c", "CAST(a * b > 2 OR c > 0.9 AS DOUBLE) AS label")
    fitted = tr.fit_jointly(two, {"gbt": tr.gradient_boosting(40, 3, 0.3)}, FEATURES, max_bins=64).model("gbt")
    rows = fitted.transform(two).collect()
    assert sum(r.prediction == r.label for r in rows) >= 0.99 * len(rows)
    assert all((walked(fitted, r)[0] > 0) == (r.prediction == 1.0) for r in rows)


def test_odd_tables(spark, frame):
    one = frame.where("label = 1")  # a single class
    fitted = tr.fit_jointly(one, SPECS | {"gbt": tr.gradient_boosting(3)}, FEATURES)
    for name in [*SPECS, "gbt"]:
        assert {r.prediction for r in fitted.model(name).transform(one).collect()} == {1.0}
    flat = frame.selectExpr("1 AS a", "2 AS b", "CAST(0 AS DOUBLE) AS c", "label")  # nothing to split on
    fitted = tr.fit_jointly(flat, SPECS, FEATURES)
    for name in SPECS:
        assert len({r.prediction for r in fitted.model(name).transform(flat).collect()}) == 1


def test_too_many_distinct_rows_are_an_error(frame, monkeypatch):
    monkeypatch.setattr(tr, "MAX_CELLS", 10)
    with pytest.raises(ValueError):
        tr.fit_jointly(frame, SPECS, FEATURES)
