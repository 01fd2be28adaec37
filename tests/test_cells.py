"""Cells of many rows: packed bins, and fits on more than a million of them."""

import numpy as np

from corpusloom.operators import trees as tr


def test_more_than_a_million_distinct_rows_are_fitted_on(spark):
    rows = spark.range(1_100_000).selectExpr(
        "id % 120 AS a", "id DIV 120 % 100 AS b", "id DIV 12000 AS c", "CAST(id % 120 < 50 AND id DIV 12000 > 30 AS DOUBLE) AS label")
    fitted = tr.fit_jointly(rows, {"tree": tr.decision_tree(2, 1, 0)}, ["a", "b", "c"], max_bins=128)
    model = fitted.model("tree")
    counts = {(r.label, r.prediction): r.n for r in tr.scored_cells(rows, {"tree": model}).groupBy("label", "prediction").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n").collect()}
    assert set(counts) == {(0.0, 0.0), (1.0, 1.0)} and sum(counts.values()) == 1_100_000
    assert float(model.trees["value"][0][0] + model.trees["value"][0][1]) == 1_100_000 * tr.WEIGHT_UNIT


def test_packed_bins(spark):
    for bins in (3, 300):
        edges = [list(map(float, range(bins))), [0.5]]
        x = [[bins, 1], [0, 0], [2, 1]]
        held = tr.packed(np.array(x).astype(tr.bin_type(edges)))
        assert tr.unpacked(held, edges).tolist() == x and tr.unpacked(held[1:], edges).tolist() == x[1:] and not len(tr.unpacked(held[:0], edges))
    frame = spark.createDataFrame([(0.0, None), (1.5, 0.5), (float("nan"), 7.0)], "a double, b double")
    rows = frame.select(tr.packed_bins(["a", "b"], [[0.0, 1.0], [0.5]]).alias("x")).collect()
    assert sorted(list(r.x) for r in rows) == [[0, 1], [2, 0], [2, 1]]


def test_cells_are_scored_on_all_cores(spark):
    rows = spark.range(2_000).selectExpr("id % 30 AS a", "id DIV 30 AS b", "CAST(id % 2 AS DOUBLE) AS label").coalesce(1)
    edges = tr.bin_edges(rows, ["a", "b"])
    table = tr.cells(rows, ["a", "b"], edges, [rows["label"]])
    assert table.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert table.agg({"n": "sum"}).first()[0] == 2_000
