"""Location and action spans by ordered rules.

A tag depends on the tag before it, but only through three states: outside, in a location, in an
action. Every token is therefore reduced to three outcomes, one per state before it, and the
outcomes of neighbouring tokens are composed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import vocab
from corpusloom.operators.annotate import LONG_FIELDS, Annotated, Coded, annotating, explode_tokens, struct_type, word_sentences_of
from corpusloom.session import small_batches

OUTSIDE, LOC_START, LOC_INNER, ACT_START, ACT_INNER = 1, 2, 3, 4, 5


@dataclass(frozen=True)
class SpanVocabulary:
    """The word lists and entity types the rules use."""

    prepositions: list[str] = field(default_factory=lambda: list(vocab.TAG_PREPOSITIONS))
    actions: list[str] = field(default_factory=lambda: list(vocab.TAG_ACTIONS))
    places: list[str] = field(default_factory=lambda: list(vocab.TAG_PLACES))
    entity_types: list[str] = field(default_factory=lambda: list(vocab.ENTITY_TYPES))


def span_codes(
    token: Coded, pos: Coded, dep: Coded, tag: Coded, lemma: Coded, entity: np.ndarray, ent_pos: np.ndarray, opens: np.ndarray,
    words: SpanVocabulary,
) -> np.ndarray:
    """The code of every token of messages that lie one after another; ``opens`` marks their first tokens.

    A token maps the state before it to a code. Maps of neighbours are composed in doubling steps until they say the same
    for every state, so the rounds grow with the logarithm of the longest run of tokens that look back.
    """
    place = lemma.isin(words.places)
    place_start = place & pos.isin(["NOUN", "PROPN"]) & dep.isin(vocab.PLACE_WORD_DEPS)
    action_start = ~place_start & (
        lemma.isin(words.actions) | pos.isin(["VERB"]) & dep.isin(["ROOT"]) & tag.isin(vocab.FINITE_TAGS)
    )
    place_inner = dep.isin(vocab.PLACE_INNER_DEPS) | pos.isin(["NUM"]) | place | token.isin(vocab.PLACE_JOINERS)
    action_inner = dep.isin(vocab.ACTION_INNER_DEPS) & pos.isin(vocab.ACTION_INNER_POS)
    after_preposition = np.zeros(len(opens), bool)
    after_preposition[1:] = lemma.isin(words.prepositions)[:-1] & ~opens[1:]
    start = np.where(place_start, LOC_START, np.where(action_start, ACT_START, OUTSIDE)).astype(np.int8)
    outcomes = np.stack([
        np.where(after_preposition, np.where(pos.isin(vocab.PLACE_HEAD_POS), LOC_START, OUTSIDE), start),
        np.where(place_inner, LOC_INNER, OUTSIDE),
        np.where((start == OUTSIDE) & action_inner, ACT_INNER, start),
    ], axis=1).astype(np.int8)
    outcomes[entity] = np.where(ent_pos[entity] == 0, LOC_START, LOC_INNER)[:, None]
    outcomes[opens] = outcomes[opens, :1]
    state = outcomes >> 1
    look_back = lambda own: (own[:, 0] != own[:, 1]) | (own[:, 1] != own[:, 2])
    open_, step = np.flatnonzero(look_back(state)), 1
    while len(open_):
        composed = np.take_along_axis(state[open_], state[open_ - step].astype(np.int64), 1)
        state[open_] = composed
        open_, step = open_[look_back(composed)], 2 * step
    before = np.concatenate([[0], state[:-1, 0]])[: len(state)].astype(np.int64)
    return np.take_along_axis(outcomes, before[:, None], 1)[:, 0]


def _labels(codes: np.ndarray) -> pa.Array:
    return Coded(codes - 1, vocab.SPAN_LABELS).arrow()


def bio_tags(tokens: Column, words: SpanVocabulary, tag: str = "tag_") -> Column:
    """One span label per token, from an array of token structs whose fine tag is the field ``tag``."""

    @F.arrow_udf("array<string>")
    def tagged(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            sizes = pc.list_value_length(part).fill_null(0).to_numpy(zero_copy_only=False)
            ends, toks = np.cumsum(sizes), part.flatten()
            opens = np.zeros(len(toks), bool)
            opens[(ends - sizes)[sizes > 0]] = True
            coded = [Coded.of(pc.struct_field(toks, name)) for name in ("token", "pos", "dep", tag, "lemma")]
            place = pc.struct_field(toks, "ent_pos")
            entity = place.is_valid().to_numpy(zero_copy_only=False)
            codes = span_codes(*coded, entity, place.fill_null(0).to_numpy(zero_copy_only=False), opens, words)
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32), mask=np.append(~part.is_valid().to_numpy(zero_copy_only=False), False))
            yield pa.ListArray.from_arrays(offsets, _labels(codes))

    return tagged(tokens)


def add_bio_tags(messages: DataFrame, words: SpanVocabulary | None = None, tokens: str = "tokens") -> DataFrame:
    """Set ``bio_tag`` in every token of the array column ``tokens``."""
    small_batches(messages.sparkSession)
    labelled = messages.withColumn("_labels", bio_tags(F.col(tokens), words or SpanVocabulary()))
    tagged = F.zip_with(tokens, "_labels", lambda tok, tag: tok.withField("bio_tag", tag))
    return labelled.withColumn(tokens, tagged).drop("_labels")


def tag_corpus(
    messages: DataFrame,
    words: SpanVocabulary | None = None,
    text: str = "raw_text",
    max_chars: int | None = None,
    fields: list[str] | None = None,
) -> DataFrame:
    """Annotate and tag every message; adds ``tokens`` with a ``bio_tag`` in each token.

    ``fields`` names the other token fields to keep, by default all of them.
    """
    words = words or SpanVocabulary()
    names = [name for name in LONG_FIELDS if fields is None or name in fields]

    def tagged(a: Annotated) -> pa.Array:
        opens = a.at == a.message_start
        codes = lambda: span_codes(
            a.word, a.pos, a.dep, a.tag, a.lemma, a.entity(words.entity_types), a.ent_pos, opens, words
        )
        return a.by_message(a.columns([*names, "bio_tag"], words.entity_types, bio_tag=lambda: _labels(codes())))

    found = annotating(tagged, f"array<{struct_type([*names, 'bio_tag'])}>")
    return word_sentences_of(messages, text, max_chars).withColumn("tokens", found("_words")).drop("_words")


def bio_tokens(tagged: DataFrame, key: str = "message_id") -> DataFrame:
    """One row per tagged token."""
    return explode_tokens(tagged, "tokens", key)


def token_lists(tagged: DataFrame, key: str = "message_id") -> DataFrame:
    """Tokens in location spans and in action spans, in order, for each message."""

    def pick(suffix: str) -> Column:
        hits = F.filter("tokens", lambda tok: F.endswith(tok["bio_tag"], F.lit(suffix)))
        return F.transform(hits, lambda tok: tok["token"])

    return tagged.select(key, pick("LOC").alias("loc_tokens"), pick("ACT").alias("act_tokens"))
