import random

from pyspark.sql import functions as F

from corpusloom.operators import clustering as cl
from corpusloom.operators import counting, metrics


def labelled(spark, counts):
    rows = [(a, b) for (a, b), n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "a int, b int")


def ari(df, a="a", b="b"):
    return metrics.adjusted_rand_index(df, a, b).first()["ari"]


def test_adjusted_rand_index(spark):
    assert ari(labelled(spark, {(0, 0): 180, (1, 1): 180})) == 1.0
    table = labelled(spark, {(0, 0): 169, (0, 1): 11, (1, 1): 180})
    assert abs(ari(table) - 0.881182614051288) < 1e-12
    assert abs(ari(table) - ari(table, "b", "a")) < 1e-15
    renamed = table.withColumn("b", 7 - F.col("b"))
    assert abs(ari(table) - ari(renamed)) < 1e-15
    assert ari(labelled(spark, {(0, 0): 5})) == 1.0
    assert ari(labelled(spark, {(0, 0): 1})) == 1.0


def test_crosstab(spark):
    rows = [(1, "AI")] * 180 + [(0, "human")] * 180
    df = spark.createDataFrame(rows, "cluster int, source string")
    got = {r["cluster"]: (r["AI"], r["human"]) for r in counting.crosstab(df, "cluster", "source", ["AI", "human"]).collect()}
    assert got == {0: (0, 180), 1: (180, 0)}


def test_reports(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)] + [(2, 0)]
    df = spark.createDataFrame(pairs, "y int, p int")
    report = {r["class"]: r for r in metrics.class_report(df, "y", "p").collect()}
    assert (report[0]["precision"], report[0]["recall"], report[0]["support"]) == (5 / 7, 5 / 7, 7)
    assert (report[2]["precision"], report[2]["recall"], report[2]["f1"]) == (0.0, 0.0, 0.0)
    means = metrics.f1_averages(df, "y", "p").first()
    f1 = [report[k]["f1"] for k in range(3)]
    assert abs(means["f1_macro"] - sum(f1) / 3) < 1e-12
    assert abs(means["f1_weighted"] - (7 * f1[0] + 4 * f1[1]) / 12) < 1e-12
    assert abs(means["accuracy"] - 8 / 12) < 1e-12
    matrix = {r["y"]: tuple(r)[1:] for r in metrics.confusion_matrix(df, "y", "p", [0, 1, 2]).collect()}
    assert matrix == {0: (5, 2, 0), 1: (1, 3, 0), 2: (1, 0, 0)}
    none = metrics.binary_metrics(df.where("p = 0 and y = 0"), "y", "p").first()
    assert (none["accuracy"], none["precision"], none["recall"], none["f1"]) == (1.0, 0.0, 0.0, 0.0)


def brute_silhouette(points, labels):
    d = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    out = []
    for i, (p, c) in enumerate(zip(points, labels)):
        by = {}
        for j, (q, e) in enumerate(zip(points, labels)):
            if i != j:
                by.setdefault(e, []).append(d(p, q))
        if c not in by:
            out.append(0.0)
            continue
        a = sum(by[c]) / len(by[c])
        b = min(sum(v) / len(v) for e, v in by.items() if e != c)
        out.append((b - a) / max(a, b))
    return out


def test_silhouette(spark):
    rng = random.Random(4)
    points = [[rng.gauss(3 * (k % 3), 1) for _ in range(4)] for k in range(60)] + [[50.0] * 4]
    labels = [k % 3 for k in range(60)] + [9]
    df = spark.createDataFrame([(i, p, c) for i, (p, c) in enumerate(zip(points, labels))], "i int, v array<double>, c int")
    rows = {r["i"]: r["silhouette"] for r in cl.silhouette_rows(df, "v", "c").collect()}
    for i, expected in enumerate(brute_silhouette(points, labels)):
        assert abs(rows[i] - expected) < 1e-9


def test_standardise(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    assert sorted(tuple(r) for r in cl.standardise(df, ["x", "y"]).collect()) == [(-1.0, 0.0), (1.0, 0.0)]


def test_clusterings(spark):
    rng = random.Random(5)
    rows = [(i, "AI" if i % 2 else "human", [10.0 * (i % 2) + rng.random(), rng.random()]) for i in range(80)]
    df = cl.vectors(spark.createDataFrame(rows, "response_id int, source_type string, v array<double>"), "v")
    labelled_rows = cl.cluster_labels(df, ["response_id", "source_type"], starts=2)
    summary = {r["method"]: r for r in cl.clustering_summary(labelled_rows, "source_type", cl.elbow(df, range(2, 4), 2)).collect()}
    assert summary["kmeans"]["ari"] == 1.0 and summary["hierarchical"]["ari"] == 1.0
    assert summary["best_k_by_silhouette"]["best_k"] == 2
    assert set(cl.pca(df).columns) >= {"pc1", "pc2"}
