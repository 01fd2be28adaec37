import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import features as ft
from corpusloom.operators import models
from corpusloom.operators import trees as tr
from corpusloom.session import materialise, scratch_path
from corpusloom.sources import tables


def test_csv_round_trip(spark, tmp_path):
    rows = [("H_1", "P1", 'say "hi", ok', "line one\nline two", "human"), ("H_2", "P1", "NA", "null", "AI")]
    df = tables.literal_table(spark, rows, schemas.RESPONSES)
    path = str(tmp_path / "csv")
    tables.write_csv(df, path)
    assert sorted(tuple(r) for r in tables.read_csv(spark, path, schemas.RESPONSES).collect()) == sorted(rows)


def test_csv_columns_by_name(spark, tmp_path):
    path = str(tmp_path / "csv")
    tables.write_csv(spark.createDataFrame([("x", 1, "t")], "extra string, target int, text string"), path)
    row = tables.read_csv(spark, path, "text string, target int").first()
    assert (row["text"], row["target"]) == ("t", 1)
    with pytest.raises(ValueError, match="missing columns: \\['id'\\]"):
        tables.read_csv(spark, path, "id bigint, text string")


def test_optional_table(spark, tmp_path):
    table = tables.read_optional(spark, str(tmp_path / "nothing"), schemas.CLUSTERS)
    assert table.count() == 0 and "kmeans_cluster" in table.columns


def test_whole_text(spark, tmp_path):
    (tmp_path / "knowledge.txt").write_text("# A\n\nline\n")
    assert [r["value"] for r in tables.read_text(spark, str(tmp_path / "knowledge.txt")).collect()] == ["# A\n\nline\n"]
    assert tables.read_text(spark, str(tmp_path / "none.txt")).first()["value"] == ""


def test_summary_round_trip(spark, tmp_path):
    metrics = spark.createDataFrame([("b", 1.0, 0.5, 0.5, 0.5), ("a", 0.9, 0.4, 0.4, 0.4)],
                                    "model string, accuracy double, precision double, recall double, f1 double")
    importances = spark.createDataFrame([(f"f{i}", float(i)) for i in range(12)], "feature string, importance double")
    alignment = spark.createDataFrame([(1.0, 0.88)], "kmeans_ari double, hierarchical_ari double")
    path = str(tmp_path / "json")
    tables.write_json(tables.summary_row(metrics, importances, alignment), path)
    back = tables.read_json(spark, path, schemas.SUMMARY)
    row = back.first()
    entries = {(r["part"], r["name"], r["field"]): r["value"] for r in tables.summary_entries(back).collect()}
    assert len(entries) == 2 * 4 + 8 + 2 and entries["classification", "a", "precision"] == 0.4
    assert entries["top_features", "f4", "importance"] == 4.0 and entries["cluster_alignment", "kmeans_ari", "ari"] == 1.0
    assert [m["model"] for m in row["classification"]] == ["a", "b"]
    assert len(row["top_features"]) == 8 and row["top_features"]["f11"] == 11.0
    assert row["cluster_alignment"]["hierarchical_ari"] == 0.88


def test_materialise(spark):
    df = spark.range(5).select("id", F.array("id").alias("a"))
    assert sorted(r["id"] for r in materialise(df, "t").collect()) == list(range(5))


def test_priority_model(spark):
    rows = []
    for i in range(300):
        label = i % 3
        word = ["pantry printer jam", "password reset locked", "database outage critical"][label]
        rows.append((i, f"[Incident] {word} | item {i}", label, "train" if i % 10 < 8 else "val" if i % 10 == 8 else "test"))
    data = spark.createDataFrame(rows, "id int, text string, label int, split string")
    model, tried = models.fit_priority_model(data, budgets=(2, 4, 8, 16), patience=2)
    assert 1 <= len(tried) <= 4
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    scored = models.score_tickets(data, PipelineModel.load(path), ["id"]).collect()
    names = ["low", "medium", "high"]
    assert sum(r["predicted_priority"] == names[r["id"] % 3] for r in scored) > 290
    assert all(abs(sum(r["probabilities"]) - 1) < 2e-4 and max(r["probabilities"]) == r["confidence"] for r in scored)


def test_encoder_table(spark, tmp_path):
    from corpusloom.operators.features import encoder_maps, fit_encoders
    from corpusloom.operators.tagging import bio_tokens, tag_corpus

    messages = spark.createDataFrame([("a", "Send boats near Delhi")], "message_id string, raw_text string")
    encoders = fit_encoders(bio_tokens(tag_corpus(messages)))
    path = str(tmp_path / "encoders")
    tables.write_csv(encoders, path)
    back = tables.read_csv(spark, path, "kind string, value string, code int")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, encoders.collect()))
    assert set(encoder_maps(back)) == {"pos", "dep", "bio"}


def test_flow_and_analysis(spark):
    from corpusloom.operators.analysis import analyse, analysed_lists
    from corpusloom.plans.flows import token_training_rows

    rows = [(i, f"Send boats near Delhi bridge {i}. Nothing else here") for i in range(60)] + [(99, " ")]
    messages = spark.createDataFrame(rows, "message_id int, raw_text string")
    data, encoders = token_training_rows(messages)
    assert {r["split"]: r["n"] for r in data.groupBy("split").agg(F.count("*").alias("n")).collect()}["train"] == 60 * 10 * 3 // 4
    train = data.where("split = 'train'")
    model = tr.fit_jointly(train, {"tree": tr.decision_tree()}, ft.TOKEN_FEATURES).model("tree")
    scored = analyse(messages, model, encoders)
    labels = {r["token"]: (r["label"], r["css"]) for r in scored.where("message_id = 7").collect()}
    assert labels["Delhi"] == ("B-LOC", "loc") and labels["boats"] == ("I-ACT", "act") and labels["here"] == ("O", "other")
    lists = {r["message_id"]: r for r in analysed_lists(scored).collect()}
    assert lists[7]["loc_tokens"][:2] == ["Delhi", "bridge"] and lists[7]["act_tokens"] == ["Send", "boats"]
    assert 99 not in lists


def test_merged_responses(spark, tmp_path):
    from corpusloom.plans.flows import merged_responses

    rows = [("H_1", "P1", "q", " long enough to be kept ", " Human"), ("H_2", "P1", "q", "too short", "human")]
    tables.write_csv(tables.literal_table(spark, rows, schemas.RESPONSES), str(tmp_path / "human"))
    merged = merged_responses(spark, [str(tmp_path / "human"), str(tmp_path / "absent")]).collect()
    assert [(r["response_text"], r["source_type"]) for r in merged] == [("long enough to be kept", "human")]


def test_message_corpus(spark):
    from corpusloom.plans.flows import message_corpus

    raw = tables.literal_table(
        spark, [(4, "flood near the bridge", None, None, 1), (5, "nice weather today", None, None, 0), (6, "short", None, None, 1)],
        schemas.RAW_TWEETS,
    )
    other = tables.literal_table(spark, [("HI_0001", " flood near the bridge ", "m"), ("HI_0002", "paani aa gaya hai", "m")], schemas.CORPUS)
    built = sorted(tuple(r) for r in message_corpus(raw, "posts", other).collect())
    assert built == [("HI_0002", "paani aa gaya hai", "m"), ("KG_00004", "flood near the bridge", "posts")]


def test_knowledge_questions(spark, tmp_path):
    from corpusloom.plans.flows import questions_with_knowledge

    (tmp_path / "k.txt").write_text("line one\nline two")
    asked = spark.createDataFrame([(1, "where?"), (2, "when?")], "id int, q string")
    prompts = {r["id"]: r["prompt"] for r in questions_with_knowledge(asked, str(tmp_path / "k.txt"), "q").collect()}
    assert "line one\nline two" in prompts[1] and prompts[2].endswith("User question:\nwhen?")


def test_choose_model():
    assert models.choose_model({"a": 1, "b": 2}, "b") == 2
    assert models.choose_model({"a": 1, "b": 2}, "none") == 1


def test_stream_equals_batch(spark, tmp_path):
    from corpusloom.operators.tagging import tag_corpus, token_lists
    from corpusloom.streaming import jobs

    source = str(tmp_path / "in")
    rows = [(str(i), f"Send boats near Delhi bridge {i}. Nothing else") for i in range(40)]
    messages = spark.createDataFrame(rows, "message_id string, raw_text string")
    messages.repartition(4).write.parquet(source)
    arriving = jobs.file_stream(spark, source, "*.parquet", "message_id string, raw_text string", files_per_batch=1)
    streamed = jobs.run_available(jobs.message_tagging(arriving), "tags").collect()
    batch = token_lists(tag_corpus(messages)).collect()
    assert sorted(map(str, streamed)) == sorted(map(str, batch))


def test_fit_reads_as_many_parts_as_cores(spark, monkeypatch):
    rows = [(f"{'fire help' if i % 2 else 'water food'} {i}", i % 2, "val" if i % 5 == 0 else "train") for i in range(200)]
    data = spark.createDataFrame(rows, "text string, label int, split string").repartition(100)
    monkeypatch.setattr(models, "with_weights", lambda df, label: df.repartition(100).withColumn("weight", F.lit(1.0)))
    parts, plain = [], models.LogisticRegression.fit
    monkeypatch.setattr(models.LogisticRegression, "fit", lambda self, df: parts.append(df.rdd.getNumPartitions()) or plain(self, df))
    models.fit_priority_model(data, budgets=(1,))
    assert parts and max(parts) <= spark.sparkContext.defaultParallelism
