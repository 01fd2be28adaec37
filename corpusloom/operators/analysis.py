"""Tagging messages with a fitted model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import vocab
from corpusloom.lookups import literal_map
from corpusloom.operators import annotate as an
from corpusloom.operators import features as ft

SCORING_WORDS = ft.FeatureVocabulary(actions=vocab.SCORING_ACTIONS)


def analyse(
    messages: DataFrame,
    model,
    encoders: DataFrame,
    words: ft.FeatureVocabulary = SCORING_WORDS,
    text: str = "raw_text",
    key: str = "message_id",
    entity_types: list[str] = vocab.SCORING_ENTITY_TYPES,
) -> DataFrame:
    """(key, token_idx, token, pos, dep, label, css) for every token; blank messages have none.

    The features are those of training, and ``model`` adds a prediction to them. Every token is scored alone, so this runs on streams too.
    """
    flat = an.annotate_long(messages, text, fields=ft.TOKEN_FIELDS, types=entity_types).select(key, "tokens")
    rows = ft.token_features(flat, ft.encoder_maps(encoders), words, key, keep=["token", "pos", "dep"])
    scored = model.transform(rows)
    label = F.element_at(ft.decoder_map(encoders), F.col("prediction").cast("int"))
    css = F.coalesce(F.element_at(literal_map(vocab.DISPLAY_CLASSES), F.col("label")), F.lit("other"))
    return scored.withColumn("label", label).select(key, "token_idx", "token", "pos", "dep", "label", css.alias("css"))


def analysed_lists(rows: DataFrame, key: str = "message_id") -> DataFrame:
    """Tokens labelled as location and as action, in order, for each message."""
    ordered = lambda css: F.transform(
        F.array_sort(F.collect_list(F.when(F.col("css") == css, F.struct("token_idx", "token")))), lambda x: x["token"]
    )
    return rows.groupBy(key).agg(ordered("loc").alias("loc_tokens"), ordered("act").alias("act_tokens"))
