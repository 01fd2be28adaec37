"""Queries that evaluate labels, cluster, and fit and score models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions import vocab
from corpusloom.operators import clustering as cl
from corpusloom.operators import analysis, counting, metrics, models
from corpusloom.operators import features as ft
from corpusloom.operators import tickets as tk
from corpusloom.operators import trees as tr
from corpusloom.plans import flows
from corpusloom.plans.corpus_queries import ticket_bodies
from corpusloom.plans.registry import messages, query, spread, table, tickets
from corpusloom.plans.token_queries import FEATURES_SQL, TEST_FEATURES, TEST_SPANS, styled
from corpusloom.plans.tree_sql import tree_sql
from corpusloom.session import materialise, scratch_path
from corpusloom.sources import tables


# ---- evaluation --------------------------------------------------------------------------------

_REPORT_SQL = """
  p AS (SELECT quality AS y, toxic AS p, count(*) AS n FROM labels GROUP BY ALL),
  r AS (SELECT class, sum(n) FILTER (y = class) AS support, coalesce(sum(n) FILTER (p.p = class), 0) AS predicted,
               coalesce(sum(n) FILTER (y = class AND p.p = class), 0) AS hits FROM p, (VALUES (0), (1)) c(class) GROUP BY class),
  s AS (SELECT class, hits, support, coalesce(hits / nullif(predicted, 0), 0) AS precision, coalesce(hits / nullif(support, 0), 0) AS recall,
               coalesce(2 * hits / nullif(predicted + support, 0), 0) AS f1 FROM r)"""


@query("""
  SELECT round(avg(CAST(quality = toxic AS INT)), 9) AS accuracy,
         round(coalesce(count_if(quality = 1 AND toxic = 1) / nullif(count_if(toxic = 1), 0), 0), 9) AS precision,
         round(coalesce(count_if(quality = 1 AND toxic = 1) / nullif(count_if(quality = 1), 0), 0), 9) AS recall,
         round(coalesce(2 * count_if(quality = 1 AND toxic = 1) / nullif(count_if(toxic = 1) + count_if(quality = 1), 0), 0), 9) AS f1 FROM labels""")
def binary_metrics(spark: SparkSession, folder: str) -> DataFrame:
    scores = metrics.binary_metrics(table(spark, folder, "labels"), "quality", "toxic")
    return scores.select(*[F.round(c, 9).alias(c) for c in scores.columns])


@query(f"""WITH {_REPORT_SQL} SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
                  CAST(support AS BIGINT) AS support FROM s""")
def class_report(spark: SparkSession, folder: str) -> DataFrame:
    report = metrics.class_report(table(spark, folder, "labels"), "quality", "toxic")
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query("""
  SELECT quality AS label, count(*) FILTER (toxic = 0) AS p0, count(*) FILTER (toxic = 1) AS p1 FROM labels GROUP BY quality""")
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    matrix = metrics.confusion_matrix(table(spark, folder, "labels"), "quality", "toxic", [0, 1])
    return matrix.withColumnsRenamed({"quality": "label", "0": "p0", "1": "p1"})


@query(f"""WITH {_REPORT_SQL} SELECT round(sum(hits) / sum(support), 9) AS accuracy, round(avg(f1), 9) AS f1_macro,
                  round(sum(f1 * support) / sum(support), 9) AS f1_weighted FROM s""")
def f1_averages(spark: SparkSession, folder: str) -> DataFrame:
    scores = metrics.f1_averages(table(spark, folder, "labels"), "quality", "toxic")
    return scores.select(*[F.round(c, 9).alias(c) for c in scores.columns])


@query("""
  WITH c AS (SELECT lang, quality, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL),
  s AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM c) AS same, (SELECT sum(x * (x - 1) / 2) FROM (SELECT sum(n) AS x FROM c GROUP BY lang)) AS a,
               (SELECT sum(x * (x - 1) / 2) FROM (SELECT sum(n) AS x FROM c GROUP BY quality)) AS b,
               (SELECT sum(n) * (sum(n) - 1) / 2 FROM c) AS t)
  SELECT round((same - a * b / t) / ((a + b) / 2 - a * b / t), 9) AS ari FROM s""")
def adjusted_rand_index(spark: SparkSession, folder: str) -> DataFrame:
    labelled = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    return metrics.adjusted_rand_index(labelled, "lang", "quality").select(F.round("ari", 9).alias("ari"))


@query("""
  WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
  d AS (SELECT x.vec_id, x.label, y.label AS other, sum(list_distance(x.v, y.v) ** 2) AS s, count(*) AS n
        FROM e x, e y WHERE x.vec_id <> y.vec_id GROUP BY ALL),
  s AS (SELECT vec_id, label, max(s / n) FILTER (label = other) AS a, min(s / n) FILTER (label <> other) AS b FROM d GROUP BY ALL)
  SELECT label, count(*) AS n, round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM s GROUP BY label""")
def silhouette(spark: SparkSession, folder: str) -> DataFrame:
    """Squared-Euclidean silhouette of the given labels, by label."""
    rows = cl.silhouette_rows(spread(table(spark, folder, "embeddings")), "embedding", "label")
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg("silhouette"), 6).alias("silhouette"))


REFERENCES = 64


@query(f"""
  WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v,
               row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR)), CAST(vec_id AS VARCHAR)) AS place FROM embeddings),
  d AS (SELECT x.vec_id, x.label, y.label AS other, avg(list_distance(x.v, y.v)) AS m
        FROM e x, e y WHERE y.place <= {REFERENCES} AND x.vec_id <> y.vec_id GROUP BY ALL),
  s AS (SELECT vec_id, label, max(m) FILTER (label = other) AS a, min(m) FILTER (label <> other) AS b FROM d GROUP BY ALL)
  SELECT label, count(*) AS n, round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) AS silhouette FROM s GROUP BY label""")
def euclidean_silhouette(spark: SparkSession, folder: str) -> DataFrame:
    """Plain Euclidean silhouette of the given labels, by label, from ``REFERENCES`` rows of each."""
    rows = cl.euclidean_silhouette_rows(spread(table(spark, folder, "embeddings")), "vec_id", "embedding", "label", REFERENCES)
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg("silhouette"), 6).alias("silhouette"))


# ---- clustering --------------------------------------------------------------------------------

@query()
def kmeans_clusters(spark: SparkSession, folder: str) -> DataFrame:
    data = cl.vectors(table(spark, folder, "embeddings"), "embedding")
    return cl.kmeans(data, k=2, starts=10).transform(data).select("vec_id", "cluster")


@query()
def elbow_table(spark: SparkSession, folder: str) -> DataFrame:
    data = flows.scaled_style_rows(styled(spark, folder))
    return cl.elbow(data).withColumn("inertia", F.round("inertia", 4))


@query()
def hierarchical_clusters(spark: SparkSession, folder: str) -> DataFrame:
    data = cl.vectors(table(spark, folder, "embeddings"), "embedding")
    return cl.hierarchical(data, k=2).transform(data).select("vec_id", "cluster")


@query()
def pca_projection(spark: SparkSession, folder: str) -> DataFrame:
    return cl.pca(flows.scaled_style_rows(styled(spark, folder))).select("response_id", "source_type", "pc1", "pc2")


@query()
def cluster_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Both clusterings of the replies against the true source, as a cross-tabulation."""
    data = flows.scaled_style_rows(styled(spark, folder))
    labelled = cl.cluster_labels(data, ["response_id", "source_type"])
    return counting.crosstab(labelled, "kmeans_cluster", "source_type", ["AI", "human"])


@query()
def clustering_summary(spark: SparkSession, folder: str) -> DataFrame:
    data = flows.scaled_style_rows(styled(spark, folder))
    labelled = materialise(cl.cluster_labels(data, ["response_id", "source_type"]), "clusters")
    return cl.clustering_summary(labelled, "source_type", cl.elbow(data))


# ---- style classifiers -------------------------------------------------------------------------

STYLE_BINS = 128  # the replies are few and their features fine
STYLE_MODELS = {
    "DecisionTree": tr.decision_tree(depth=5, leaf=4, balance=0),
    "AdaBoost": tr.ada_boost(rounds=100, depth=2, rate=0.6, balance=0),
    "GradientBoosting": tr.gradient_boosting(rounds=120, depth=3, rate=0.08),
}


def style_matrix(spark: SparkSession, folder: str, folds: int | None = None) -> DataFrame:
    return flows.style_training_rows(styled(spark, folder), folds)


def _train_test(data: DataFrame) -> tuple[DataFrame, DataFrame]:
    return data.where(F.col("split") == "train"), data.where(F.col("split") == "test")


def _held_out_style_scores(data: DataFrame) -> tuple[DataFrame, dict[str, tr.EnsembleModel]]:
    train, test = _train_test(data)
    fitted = tr.fit_jointly(train, STYLE_MODELS, ft.STYLE_FEATURES, max_bins=STYLE_BINS)
    found = {name: fitted.model(name) for name in STYLE_MODELS}
    scored = tr.scored_cells(test, found)
    return metrics.binary_metrics(scored, "label", "prediction", 1.0, by=["model"], count="n"), found


def _style_fold_scores(data: DataFrame) -> DataFrame:
    scores = tr.cross_validated(data, STYLE_MODELS, ft.STYLE_FEATURES, positive=1.0, max_bins=STYLE_BINS)
    return counting.fold_statistics(scores, "model", "score")


@query()
def style_classification(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of three classifiers on the held-out quarter."""
    return _held_out_style_scores(style_matrix(spark, folder))[0]


@query()
def style_cross_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Mean and deviation of F1 over five folds, by classifier."""
    return _style_fold_scores(style_matrix(spark, folder, folds=5))


@query()
def classification_table(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out scores of every classifier beside the mean and deviation of its F1 over five folds."""
    data = style_matrix(spark, folder, folds=5)
    folds = _style_fold_scores(data).select("model", F.col("mean").alias("cv_f1_mean"), F.col("std").alias("cv_f1_std"))
    return _held_out_style_scores(data)[0].join(folds, "model")


@query()
def style_importances(spark: SparkSession, folder: str) -> DataFrame:
    """Feature importances of the boosted trees, greatest first, top eight."""
    train, _ = _train_test(style_matrix(spark, folder))
    name = "GradientBoosting"
    model = tr.fit_jointly(train, {name: STYLE_MODELS[name]}, ft.STYLE_FEATURES, max_bins=STYLE_BINS).model(name)
    rows = models.importance_rows(spark, {name: model}, ft.STYLE_FEATURES)
    return rows.orderBy(F.desc("importance"), "feature").limit(8)


@query()
def style_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The nested summary of the corpus, written as JSON and read back, a row for each entry.

    Scores of the fitted classifiers, their eight greatest importances, and both clusterings against the true source.
    """
    styles = materialise(styled(spark, folder), "styles")
    scores, found = _held_out_style_scores(flows.style_training_rows(styles))
    name = "GradientBoosting"
    importances = models.importance_rows(spark, {name: found[name]}, ft.STYLE_FEATURES).drop("model")
    data = flows.scaled_style_rows(styles)
    labelled = materialise(cl.cluster_labels(data, ["response_id", "source_type"]), "clusters")
    alignment = metrics.adjusted_rand_index(labelled, "source_type", "kmeans_cluster").withColumnRenamed("ari", "kmeans_ari")
    hierarchical = metrics.adjusted_rand_index(labelled, "source_type", "hierarchical_cluster").scalar()
    path = scratch_path(spark, "summary-json")
    tables.write_json(tables.summary_row(scores, importances, alignment.withColumn("hierarchical_ari", hierarchical)), path)
    return tables.summary_entries(tables.read_json(spark, path, schemas.SUMMARY))


# ---- token classifiers -------------------------------------------------------------------------

# In cross-validation, about so many tokens are fitted on, chosen by the md5 of their id; all tokens are scored.
FIT_TOKENS = 200_000
TOKEN_MODELS = {"AdaBoost": tr.ada_boost(), "Decision Tree": tr.decision_tree(), "Random Forest": tr.random_forest()}
# Cross-validation balances the classes once.
FOLD_MODELS = {"AdaBoost": tr.ada_boost(), "Decision Tree": tr.decision_tree(balance=1), "Random Forest": tr.random_forest(balance=1)}


def corpus_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The emergency corpus: all documents, whole texts."""
    return spread(messages(spark, folder).select("message_id", "raw_text"))


def token_matrix(spark: SparkSession, folder: str, folds: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The tokens of all documents, and the encoders of their features."""
    return flows.token_training_rows(corpus_messages(spark, folder), TEST_SPANS, TEST_FEATURES, folds)


def _token_models(train: DataFrame, names: list[str]) -> dict[str, tr.EnsembleModel]:
    fitted = tr.fit_jointly(train, {name: TOKEN_MODELS[name] for name in names}, ft.TOKEN_FEATURES)
    return {name: fitted.model(name) for name in names}


def _scored_tests(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """(model, label, prediction, n): how often each model gives each label to test tokens of each label, by name."""
    data, encoders = token_matrix(spark, folder)
    train, test = _train_test(data)
    names_of = ft.decoder_map(encoders)
    scored = tr.scored_cells(test, _token_models(train, names))
    named = {c: F.element_at(names_of, F.col(c).cast("int")) for c in ("label", "prediction")}
    return scored.withColumns(named).groupBy("model", "label", "prediction").agg(F.sum("n").alias("n"))


def _token_report(spark: SparkSession, folder: str, name: str) -> DataFrame:
    scored = materialise(_scored_tests(spark, folder, [name]), "scored")
    report = metrics.class_report(scored, "label", "prediction", by=["model"], count="n")
    average = metrics.f1_averages(scored, "label", "prediction", by=["model"], count="n")
    return report.join(average.select("model", "f1_macro"), "model")


_TREE = FEATURES_SQL + "," + tree_sql(TOKEN_MODELS["Decision Tree"].depth, TOKEN_MODELS["Decision Tree"].leaf,
                                      TOKEN_MODELS["Decision Tree"].balance) + """,
  names AS (SELECT code, value FROM enc WHERE kind = 'bio'),
  pairs AS MATERIALIZED (SELECT l.value AS y, g.value AS p, count(*) AS n FROM parted JOIN predicted USING (b)
      JOIN names l ON l.code = bio_enc JOIN names g ON g.code = p WHERE NOT train GROUP BY ALL)"""


@query(_TREE + """,
  sides AS (SELECT class, coalesce(sum(n) FILTER (y = class), 0) AS support, coalesce(sum(n) FILTER (p = class), 0) AS predicted,
              coalesce(sum(n) FILTER (y = class AND p = class), 0) AS hits
    FROM pairs, (SELECT y AS class FROM pairs UNION SELECT p FROM pairs) GROUP BY class),
  scores AS (SELECT class, coalesce(hits / nullif(predicted, 0), 0) AS precision, coalesce(hits / nullif(support, 0), 0) AS recall,
              coalesce(2 * hits / nullif(predicted + support, 0), 0) AS f1, support FROM sides)
  SELECT 'Decision Tree' AS model, class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
         CAST(support AS BIGINT) AS support, round(avg(f1) OVER (), 9) AS f1_macro FROM scores""")
def decision_tree_report(spark: SparkSession, folder: str) -> DataFrame:
    report = _token_report(spark, folder, "Decision Tree")
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1", "f1_macro")})


@query(_TREE + " SELECT y AS label, p AS prediction, n FROM pairs")
def token_confusion(spark: SparkSession, folder: str) -> DataFrame:
    """How often the fitted decision tree gives each label to test tokens of each label."""
    return _scored_tests(spark, folder, ["Decision Tree"]).drop("model")


@query()
def random_forest_report(spark: SparkSession, folder: str) -> DataFrame:
    return _token_report(spark, folder, "Random Forest")


@query()
def adaboost_report(spark: SparkSession, folder: str) -> DataFrame:
    return _token_report(spark, folder, "AdaBoost")


@query()
def importance_table(spark: SparkSession, folder: str) -> DataFrame:
    """Importances of the token features by model, missing ones 0, with their mean, greatest first."""
    train, _ = _train_test(token_matrix(spark, folder)[0])
    rows = models.importance_rows(spark, _token_models(train, list(TOKEN_MODELS)), ft.TOKEN_FEATURES)
    return counting.wide_means(rows, "feature", "model", "importance", list(TOKEN_MODELS))


@query()
def best_token_model(spark: SparkSession, folder: str) -> DataFrame:
    """The classifier with the greatest held-out macro F1; the first listed among equals."""
    scored = _scored_tests(spark, folder, list(TOKEN_MODELS))
    scores = metrics.f1_averages(scored, "label", "prediction", by=["model"], count="n")
    place = F.array_position(F.array(*[F.lit(name) for name in TOKEN_MODELS]), F.col("model"))
    return counting.best_of(scores.withColumn("place", place), "model", "f1_macro", "place")


@query()
def token_cross_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Mean and deviation of macro F1 over five folds, by classifier; each fit reads about ``FIT_TOKENS`` tokens."""
    data, _ = token_matrix(spark, folder, folds=5)
    some = materialise(models.some_rows(data, "token_id", FIT_TOKENS * 5 // 4), "fit-rows")
    return counting.fold_statistics(tr.cross_validated(data, FOLD_MODELS, ft.TOKEN_FEATURES, fit_rows=some), "model", "score")


@query(_TREE + """
  SELECT message_id, token_idx, token, pos, dep, value AS label,
         CASE WHEN ends_with(value, 'LOC') THEN 'loc' WHEN ends_with(value, 'ACT') THEN 'act' ELSE 'other' END AS css
  FROM parted JOIN predicted g ON g.b = scored_b JOIN names ON code = p""")
def token_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of all documents labelled by a fitted model; an unknown name falls back to the first one."""
    corpus = corpus_messages(spark, folder)
    data, encoders = flows.token_training_rows(corpus, TEST_SPANS, TEST_FEATURES)
    fitted = _token_models(_train_test(data)[0], ["Decision Tree"])
    return analysis.analyse(corpus, models.choose_model(fitted, "random_forest"), encoders, TEST_FEATURES)


@query(_TREE + """
  SELECT message_id, coalesce(string_agg(token, ' ' ORDER BY token_idx) FILTER (ends_with(value, 'LOC')), '') AS loc_tokens,
         coalesce(string_agg(token, ' ' ORDER BY token_idx) FILTER (ends_with(value, 'ACT')), '') AS act_tokens
  FROM parted JOIN predicted g ON g.b = scored_b JOIN names ON code = p GROUP BY message_id""")
def scored_token_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Location and action tokens of every document with tokens, by the fitted model."""
    lists = analysis.analysed_lists(token_scores(spark, folder))
    return lists.select("message_id", F.array_join("loc_tokens", " ").alias("loc_tokens"), F.array_join("act_tokens", " ").alias("act_tokens"))


# ---- ticket classifier -------------------------------------------------------------------------

def ticket_split(spark: SparkSession, folder: str) -> DataFrame:
    return flows.ticket_training_rows(tickets(spark, folder), "doc_id")


@query()
def priority_report(spark: SparkSession, folder: str) -> DataFrame:
    """Per-class results of the chosen classifier on the test rows."""
    data = ticket_split(spark, folder)
    model, _ = models.fit_priority_model(data)
    scored = model.transform(data.where(F.col("split") == "test")).withColumn("prediction", F.col("prediction").cast("int"))
    report = metrics.class_report(scored, "label", "prediction")
    names = F.array(*[F.lit(p) for p in vocab.PRIORITY_CODES])
    return report.select(F.get(names, F.col("class")).alias("priority"), "precision", "recall", "f1", "support")


@query()
def ticket_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Priority, confidence and probabilities of every ticket in every language."""
    model, _ = models.fit_priority_model(ticket_split(spark, folder))
    raw = tickets(spark, folder).withColumn("text", F.lit(None).cast("string"))
    scored = models.score_tickets(tk.scoring_text(spread(raw)), model, ["doc_id"])
    return scored.select("doc_id", "predicted_priority", "confidence", "probabilities.*")


@query()
def request_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Nested JSON requests with the number of their scored tickets and the priority of each."""
    model, _ = models.fit_priority_model(ticket_split(spark, folder))
    scored = models.score_requests(ticket_bodies(spark, folder), model, ["doc_id"], F.col("body"))
    return scored.select("doc_id", "count", F.transform("results", lambda r: r["predicted_priority"]).alias("priorities"))
