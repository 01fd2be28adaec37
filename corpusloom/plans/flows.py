"""The stages of each corpus from its table to rows that models can be fitted on.

Frames that several later passes read are written once to the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions import vocab
from corpusloom.operators import annotate as an
from corpusloom.operators import clustering as cl
from corpusloom.operators import chat, corpus, split, tagging
from corpusloom.operators import features as ft
from corpusloom.operators import tickets as tk
from corpusloom.session import materialise
from corpusloom.sources import tables


def merged_responses(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Response files that are there, normalised and put together."""
    parts = [corpus.load_responses(tables.read_optional(spark, path, schemas.RESPONSES)) for path in paths]
    return reduce(lambda a, b: a.unionByName(b), parts)


def message_corpus(raw: DataFrame, source: str, *others: DataFrame, more_than: int = 10) -> DataFrame:
    """Raw posts and further messages (message_id, raw_text, source) as one clean corpus."""
    every = corpus.union_sources(corpus.filter_messages(raw, source), *others)
    ranked = every.withColumn("id_length", F.length("message_id"))  # KG_99999 comes before KG_100000
    cleaned = corpus.clean_corpus(ranked, more_than, order=["source_rank", "id_length", "message_id"])
    return cleaned.select("message_id", "raw_text", "source")


def questions_with_knowledge(questions: DataFrame, path: str, question: str) -> DataFrame:
    """Prompts grounded in one knowledge file; an absent file is an empty text, several are an error."""
    knowledge = tables.read_text(questions.sparkSession, path).select("value").scalar()
    return chat.grounded_prompts(questions, knowledge, question)


def _parted(rows: DataFrame, key: str, folds: int | None) -> DataFrame:
    parted = split.stratified_split(rows, "label", key, {"train": 75, "test": 25})
    return split.stratified_folds(parted, "label", key, folds) if folds else parted


def token_training_rows(
    messages: DataFrame,
    words: tagging.SpanVocabulary | None = None,
    feature_words: ft.FeatureVocabulary | None = None,
    folds: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Messages (message_id, raw_text) to token rows and encoders.

    Rows have token_id, the 13 features, label, split (75/25) and, if asked for, a fold.
    """
    tagged = tagging.tag_corpus(messages, words, fields=ft.TOKEN_FIELDS)
    held = materialise(ft.token_columns(tagged, feature_words), "token-columns")
    encoders = materialise(ft.fit_encoders(held), "encoders")
    rows = ft.encode_tokens(held, ft.encoder_maps(encoders)).withColumn("label", F.col("bio_enc").cast("double"))
    keyed = rows.withColumn("token_id", F.concat_ws("#", "message_id", "token_idx"))
    parted = _parted(keyed, "token_id", folds)
    extra = ["fold"] if folds else []
    kept = parted.select("token_id", *ft.TOKEN_FEATURES, "label", "split", *extra)
    return materialise(kept, "token-rows"), encoders


def style_rows(
    responses: DataFrame, hedges: list[str] = vocab.HEDGES, discourse: list[str] = vocab.DISCOURSE
) -> DataFrame:
    """Responses (response_id, response_text, source_type) to their style features."""
    annotated = an.annotate(responses, "response_text", fields=["token", "pos", "tag", "dep", "lemma", "head_off"])
    return ft.style_features(annotated, hedges=hedges, discourse=discourse)


def style_training_rows(styles: DataFrame, folds: int | None = None) -> DataFrame:
    """Style features to rows with the features, label (1 is AI), split (75/25) and, if asked for, a fold."""
    rows = styles.withColumn("label", (F.col("source_type") == "AI").cast("double"))
    held = materialise(rows.select("response_id", "label", *ft.STYLE_FEATURES), "style-features")
    return materialise(_parted(held, "response_id", folds), "style-rows")


def scaled_style_rows(styles: DataFrame) -> DataFrame:
    """Style features to standardised vectors."""
    raw = materialise(styles.select("response_id", "source_type", *ft.STYLE_FEATURES), "style-features")
    scaled = cl.assemble(cl.standardise(raw, ft.STYLE_FEATURES), ft.STYLE_FEATURES)
    return materialise(scaled.select("response_id", "source_type", "features"), "style-vectors")


def ticket_training_rows(tickets: DataFrame, key: str) -> DataFrame:
    """Tickets to text, label, priority and split (80/10/10)."""
    rows = materialise(tk.training_tickets(tickets).select(key, "text", "label", "priority"), "tickets")
    return split.stratified_split(rows, "label", key, {"train": 80, "val": 10, "test": 10})
