"""The registered model queries fit models of full size."""

import os

import pytest
from pyspark.ml.classification import LogisticRegression

import __spark_entry__ as entry
from corpusloom.operators import clustering as cl
from corpusloom.operators import models
from corpusloom.operators.features import TOKEN_FEATURES
from corpusloom.plans import model_queries as mq

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_sizes_of_ensembles():
    sizes = {name: (s.trees, s.depth, s.leaf, s.rate) for name, s in mq.TOKEN_MODELS.items()}
    assert sizes == {"AdaBoost": (200, 4, 1, 0.5), "Decision Tree": (1, 12, 3, 1.0), "Random Forest": (300, 15, 2, 1.0)}
    sizes = {name: (s.trees, s.depth, s.leaf, s.rate) for name, s in mq.STYLE_MODELS.items()}
    assert sizes == {"DecisionTree": (1, 5, 4, 1.0), "AdaBoost": (100, 2, 1, 0.6), "GradientBoosting": (120, 3, 1, 0.08)}
    assert [s.balance for s in mq.TOKEN_MODELS.values()] == [1, 2, 2] and [s.balance for s in mq.FOLD_MODELS.values()] == [1, 1, 1]


def rows(spark, name):
    return [r.asDict() for r in entry.queries()[name](spark, FOLDER).collect()]


def test_every_token_model_is_reported(spark):
    reports = {name: rows(spark, f"{name}_report") for name in ("decision_tree", "adaboost", "random_forest")}
    support = {r["class"]: r["support"] for r in reports["decision_tree"]}
    assert set(support) == {"O", "B-LOC", "I-LOC", "B-ACT", "I-ACT"}
    for report in reports.values():
        assert {r["class"]: r["support"] for r in report} == support and len({r["f1_macro"] for r in report}) == 1
        assert all(r["f1"] > 0.8 for r in report if r["class"] in ("O", "B-LOC", "B-ACT"))


def test_importances_of_token_models(spark):
    table = rows(spark, "importance_table")
    assert {r["feature"] for r in table} == set(TOKEN_FEATURES)
    for model in mq.TOKEN_MODELS:
        assert abs(sum(r[model] for r in table) - 1) < 1e-3
    assert [r["mean"] for r in table] == sorted((r["mean"] for r in table), reverse=True)


def test_cross_validation_of_token_models(spark):
    table = {r["model"]: r for r in rows(spark, "token_cross_validation")}
    assert set(table) == set(mq.FOLD_MODELS) and all(0.4 < r["mean"] <= 1 and 0 <= r["std"] < 0.2 for r in table.values())


def test_style_models(spark):
    table = {r["model"]: r for r in rows(spark, "classification_table")}
    assert set(table) == set(mq.STYLE_MODELS)
    assert all(0.5 < r[c] <= 1 for r in table.values() for c in ("accuracy", "f1", "cv_f1_mean")) and all(0 <= r["cv_f1_std"] < 0.3 for r in table.values())
    summary = rows(spark, "style_summary")
    parts = {p: [r for r in summary if r["part"] == p] for p in ("classification", "top_features", "cluster_alignment")}
    assert {p: len(r) for p, r in parts.items()} == {"classification": 12, "top_features": 8, "cluster_alignment": 2}
    scores = {(r["name"], r["field"]): r["value"] for r in parts["classification"]}
    assert all(abs(scores[m, c] - table[m][c]) < 1e-9 for m in table for c in ("accuracy", "precision", "recall", "f1"))


def test_clusterings_try_every_k_from_ten_starts(spark, monkeypatch):
    seen, real = [], cl.kmeans

    def kmeans(df, k, starts=10, *args):
        seen.append((k, starts))
        return real(df, k, 1, *args)

    monkeypatch.setattr(cl, "kmeans", kmeans)
    entry.queries()["clustering_summary"](spark, FOLDER)
    entry.queries()["elbow_table"](spark, FOLDER)
    assert seen == [(2, 10)] + 2 * [(k, 10) for k in range(2, 8)]


@pytest.mark.parametrize("name", ["priority_report", "ticket_scores", "stream_ticket_scores"])
def test_ticket_models_are_selected(spark, monkeypatch, name):
    seen, real = [], LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, *a: seen.append(self.getMaxIter()) or real(self, *a))
    assert entry.queries()[name](spark, FOLDER).count() > 0
    assert len(seen) >= 3 and seen == [5, 10, 20, 40][: len(seen)]


def test_all_tokens_of_all_documents_are_scored(spark):
    tokens = entry.queries()["tokens"](spark, FOLDER).groupBy("message_id").count()
    scored = entry.queries()["token_scores"](spark, FOLDER).groupBy("message_id").count()
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, tokens.collect()))


def test_bounded_rows_for_a_fit(spark):
    rows = spark.range(20_000)
    assert models.some_rows(rows, "id", 20_000).count() == 20_000
    some = models.some_rows(rows, "id", 5_000)
    assert 4_500 < some.count() < 5_500
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, models.some_rows(rows.repartition(7), "id", 5_000).collect()))
