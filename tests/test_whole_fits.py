"""Models are fitted on every training row, however many there are."""

import pytest

from corpusloom.operators import trees as tr
from corpusloom.plans import model_queries as mq


@pytest.fixture()
def corpus(spark, monkeypatch):
    text = "Trapped being near the station . Help thing sending to Kothrud Road in {} ! walking from a brother {}"
    rows = [(i, " ".join(text.format(i % 7, "ing " * (i % 5)) for _ in range(1 + i % 3))) for i in range(40)]
    frame = spark.createDataFrame(rows, "message_id int, raw_text string")
    monkeypatch.setattr(mq, "corpus_messages", lambda *_: frame)


@pytest.mark.parametrize("name, ask", [
    ("Decision Tree", lambda spark: mq.token_confusion(spark, "")), ("Decision Tree", lambda spark: mq.decision_tree_report(spark, "")),
    ("Random Forest", lambda spark: mq.random_forest_report(spark, "")), ("AdaBoost", lambda spark: mq.adaboost_report(spark, "")),
    ("Decision Tree", lambda spark: mq.token_scores(spark, "")), ("Decision Tree", lambda spark: mq.scored_token_lists(spark, "")),
    (None, lambda spark: mq.importance_table(spark, "")), (None, lambda spark: mq.best_token_model(spark, "")),
])
def test_token_models_read_every_training_token(spark, corpus, monkeypatch, name, ask):
    seen, real = [], tr.fit_jointly
    monkeypatch.setattr(mq, "FIT_TOKENS", 100)
    monkeypatch.setattr(mq, "TOKEN_MODELS", {"AdaBoost": tr.ada_boost(2), "Decision Tree": tr.decision_tree(), "Random Forest": tr.random_forest(2)})

    def fitted(rows, specs, *args, **more):
        seen.append((set(specs), rows.count()))
        return real(rows, specs, *args, **more)

    monkeypatch.setattr(tr, "fit_jointly", fitted)
    assert ask(spark).count() > 0
    train = mq.token_matrix(spark, "")[0].where("split = 'train'").count()
    assert train > 500 and seen == [({name} if name else set(mq.TOKEN_MODELS), train)]
