"""Sentences and annotated tokens.

One row per message holds ``sentences ARRAY<ARRAY<token>>``. All neighbour rules work inside the
row, so annotating a corpus is a map over messages: no exchange, no state. Any annotator may fill
the same column; the built-in one is a lexicon with suffix rules. Words are cut by Spark; the rules
run on Arrow batches, once for each distinct word and on whole columns of tokens for the rest.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.functions import vocab
from corpusloom.functions.arrays import explode_rows
from corpusloom.session import small_batches

# A word keeps its combining marks; white space of any kind is no token.
TOKEN_PATTERN = r"[\p{L}\p{N}][\p{L}\p{N}\p{M}]*|[^\s\x1c-\x1f\x85\p{Z}\p{L}\p{N}]"
SENTENCE_BREAK = rf"(?<=[.!?]){t.SPACE}+"
# Fields of a token in ``sentences`` and in the long form.
SENTENCE_FIELDS = ["sent_idx", "token", "pos", "tag", "dep", "lemma", "head_off", "ent_pos", "ent_type"]
LONG_FIELDS = ["token_idx", "sent_idx", "token", "pos", "tag_", "dep", "lemma", "head_idx", "ent_pos", "is_ent"]


def word_sentences(text: Column) -> Column:
    """Tokens by sentence, however long it is."""
    words = F.transform(
        F.split(text, SENTENCE_BREAK), lambda s: F.regexp_extract_all(s, F.lit(TOKEN_PATTERN), F.lit(0))
    )
    return F.filter(words, lambda ws: F.size(ws) > 0)
POS = ["NOUN", "PROPN", "VERB", "ADJ", "ADV", "ADP", "DET", "PRON", "AUX", "CCONJ", "NUM", "PUNCT", "SYM"]
DEPS = ["ROOT", "punct", "pobj", "compound", "dobj", "nsubj", "amod", "advmod", "conj", "dep"]
TYPES = {
    "sent_idx": "int", "token": "string", "pos": "string", "tag": "string", "dep": "string", "lemma": "string", "head_off": "int",
    "ent_pos": "int", "ent_type": "string", "token_idx": "int", "tag_": "string", "head_idx": "int", "is_ent": "int", "bio_tag": "string",
}
#: About so many tokens of a batch are annotated at once, whole messages always.
SLICE_TOKENS = 1 << 18
#: So many words a task remembers the rules' results of.
KNOWN_WORDS = 1 << 17


def word_sentences_of(messages: DataFrame, text: str, max_chars: int | None) -> DataFrame:
    """Add ``_words``, the words by sentence; a null text is empty."""
    small_batches(messages.sparkSession)
    source = F.coalesce(F.col(text), F.lit(""))
    if max_chars is not None:
        source = F.substring(source, 1, max_chars)
    return messages.withColumn("_words", word_sentences(source))


# ---- rules of one word ---------------------------------------------------------------------------

_CLASSES = [("ADP", vocab.ADPOSITIONS), ("DET", vocab.DETERMINERS), ("PRON", vocab.PRONOUNS), ("AUX", vocab.AUXILIARIES),
            ("CCONJ", vocab.CONJUNCTIONS), ("VERB", vocab.verb_forms())]
_LISTED = {word: pos for pos, listed in reversed(_CLASSES) for word in listed}
_BASE, _BE, _ORG = frozenset(vocab.BASE_VERBS), frozenset(vocab.BE_FORMS), frozenset(vocab.ORG_WORDS)
_VERB_ENDING = re.compile("(ing|ed|es|s)$")
# The fine tag of each part of speech that needs no closer look.
_PLAIN_TAGS = {
    "PROPN": "NNP", "PUNCT": ".", "ADP": "IN", "DET": "DT", "PRON": "PRP", "AUX": "MD", "CCONJ": "CC", "NUM": "CD",
    "ADV": "RB", "ADJ": "JJ", "SYM": "SYM",
}


def _pos(word: str, low: str, first: bool) -> str:
    """Part of speech from the lexicon, the case of the first letter, and the ending."""
    kind = unicodedata.category(word[0])
    if kind[0] != "L":
        if all(unicodedata.category(c)[0] == "N" for c in word):
            return "NUM"
        if kind[0] == "P" and len(word) == 1:
            return "PUNCT"
        if kind[0] != "N":
            return "SYM"
    if low in _LISTED:
        return _LISTED[low]
    if not first and word != low and kind == "Lu":
        return "PROPN"
    size = len(low)
    if low.endswith("ing") and size >= 5 or low.endswith("ed") and size >= 4:
        return "VERB"
    if low.endswith("ly") and size >= 3:
        return "ADV"
    if low.endswith(("ful", "ous")) and size >= 4 or low.endswith(("less", "able")) and size >= 5:
        return "ADJ"
    return "NOUN"


def _lemma(low: str, pos: str) -> str:
    if pos == "NOUN" and low.endswith("s") and len(low) >= 4:
        if low.endswith("ies") and len(low) >= 6:
            return low[:-3] + "y"
        return low if low.endswith(("ss", "us", "is")) else low[:-1]
    if pos == "VERB" and low not in _BASE:
        stem = _VERB_ENDING.sub("", low)
        for base in (stem, stem + "e", stem[:-1]):
            if base in _BASE:
                return base
        return stem if len(stem) >= 3 else low
    return "be" if pos == "AUX" and low in _BE else low


def _tag(low: str, pos: str, after_be: bool) -> str:
    if pos == "NOUN":
        return "NNS" if len(low) >= 2 and low.endswith("s") and not low.endswith(("ss", "us")) else "NN"
    if pos == "VERB":
        if low in _BASE:
            return "VB"
        if low.endswith("ing"):
            return "VBG"
        if low.endswith("ed"):
            return "VBN" if after_be else "VBD"
        return "VBZ" if low.endswith("s") else "VBD"
    return _PLAIN_TAGS[pos]


@lru_cache(KNOWN_WORDS)
def _facts(word: str, first: bool) -> tuple[int, str, str, str, bool, bool]:
    """Of a word that opens its sentence or not: part of speech, lemma, tags, and whether it is a form of be or ends an organisation."""
    low = word.lower()
    pos = _pos(word, low, first)
    return POS.index(pos), _lemma(low, pos), _tag(low, pos, False), _tag(low, pos, True), low in _BE, low in _ORG


# ---- rules of neighbours -------------------------------------------------------------------------

@dataclass
class Coded:
    """A column of few values: the place of each row's value in ``names``."""

    codes: np.ndarray
    names: list[str | None]

    @staticmethod
    def of(column: pa.Array) -> "Coded":
        held = column.dictionary_encode()
        names = held.dictionary.to_pylist()
        return Coded(held.indices.fill_null(len(names)).to_numpy(zero_copy_only=False), [*names, None])

    def isin(self, values: list[str]) -> np.ndarray:
        """Whether each row's value is listed; null never is."""
        listed = frozenset(values) - {None}
        return np.array([name in listed for name in self.names], bool)[self.codes]

    def arrow(self, null: np.ndarray | None = None) -> pa.Array:
        return pa.array(self.names, pa.string()).take(pa.array(self.codes, mask=null))


class Annotated:
    """The tokens of some messages, one after another, with what the rules say; only what is asked for is worked out.

    The head is the nearest earlier verb; the first verb, or else the first token, is the root. An
    entity is a run of proper nouns, an organisation when it ends in an organisation word. The last verb and
    the start of a run are carried along, so the work grows in proportion to the tokens.
    """

    def __init__(self, words: pa.ListArray, pos_names: list[str]) -> None:
        sentences = words.flatten()
        self.token, self.pos_names = sentences.flatten(), pos_names
        in_message, in_sentence = (pc.list_value_length(x).fill_null(0).to_numpy(zero_copy_only=False) for x in (words, sentences))
        self.sentences = np.concatenate([[0], np.cumsum(in_sentence)])
        self.messages = np.concatenate([[0], np.cumsum(in_message)])  # in sentences
        self.size = len(self.token)
        self.sentence_of = np.repeat(np.arange(len(in_sentence)), in_sentence)
        self.start = self.sentences[:-1][self.sentence_of]
        self.at = np.arange(self.size)
        self.opens = self.at == self.start
        held = self.token.dictionary_encode()
        forms = held.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 2 + self.opens
        seen = np.flatnonzero(np.bincount(forms, minlength=2 * len(held.dictionary)))
        place = np.zeros(2 * len(held.dictionary), np.int32)
        place[seen] = np.arange(len(seen))
        distinct = held.dictionary.to_pylist()
        self.word = Coded(held.indices.to_numpy(zero_copy_only=False), distinct)
        facts = [_facts(distinct[form >> 1], bool(form & 1)) for form in seen.tolist()]
        self.form = place[forms]
        self.pos_of, self.lemmas, self.plain, self.after_be, self.be, self.org = zip(*facts) if facts else ((),) * 6
        self.codes = np.array(self.pos_of, np.int8)[self.form]

    def beside(self, values: np.ndarray, step: int, none) -> np.ndarray:
        """The value of the token before (-1) or behind (1) in the same sentence."""
        found = np.full(self.size, none, values.dtype)
        if step < 0:
            found[1:] = np.where(self.opens[1:], none, values[:-1])
        else:
            found[:-1] = np.where(self.opens[1:], none, values[1:])
        return found

    @cached_property
    def message_start(self) -> np.ndarray:
        """Where the message of each token starts."""
        return self.sentences[self.messages[:-1]][self.message_of]

    @cached_property
    def message_of(self) -> np.ndarray:
        sizes = np.diff(self.messages)
        return np.repeat(np.arange(len(sizes)), sizes)[self.sentence_of]

    @cached_property
    def verb(self) -> np.ndarray:
        return self.codes == POS.index("VERB")

    @cached_property
    def root(self) -> np.ndarray:
        """The first verb of each token's sentence, or its first token."""
        verbs = np.flatnonzero(self.verb)
        firsts = verbs[np.diff(self.sentence_of[verbs], prepend=-1) != 0]
        root = self.sentences[:-1].copy()
        root[self.sentence_of[firsts]] = firsts
        return root[self.sentence_of]

    @cached_property
    def head(self) -> np.ndarray:
        last = np.maximum.accumulate(np.where(self.verb, self.at, -1))
        before = np.concatenate([[-1], last[:-1]])[: self.size]
        return np.where(before >= self.start, before, self.root)

    @cached_property
    def proper(self) -> np.ndarray:
        return self.codes == POS.index("PROPN")

    @cached_property
    def ent_pos(self) -> np.ndarray:
        """The place of a proper noun in its run; of no meaning for others."""
        starts = self.proper & ~self.beside(self.proper, -1, False)
        return self.at - np.maximum.accumulate(np.where(starts, self.at, 0))

    @cached_property
    def ent_type(self) -> Coded:
        stops = np.flatnonzero(self.proper & ~self.beside(self.proper, 1, False))
        found, own = np.zeros(self.size, np.int8), np.flatnonzero(self.proper)
        found[own] = np.array(self.org, bool)[self.form][stops][np.searchsorted(stops, own)]
        return Coded(found, ["GPE", "ORG"])

    def entity(self, types: list[str] | None) -> np.ndarray:
        """Tokens in an entity, of one of the given types if there are any."""
        return self.proper if types is None else self.proper & self.ent_type.isin(types)

    @cached_property
    def pos(self) -> Coded:
        return Coded(self.codes, self.pos_names)

    @cached_property
    def lemma(self) -> Coded:
        return Coded(self.form, list(self.lemmas))

    @cached_property
    def tag(self) -> Coded:
        names = sorted(set(self.plain) | set(self.after_be))
        places = {name: i for i, name in enumerate(names)}
        plain, after = (np.array([places[x] for x in own], np.int8)[self.form] for own in (self.plain, self.after_be))
        return Coded(np.where(self.beside(np.array(self.be, bool)[self.form], -1, False), after, plain), names)

    @cached_property
    def dep(self) -> Coded:
        code = {name: i for i, name in enumerate(POS)}
        is_in = lambda codes, *names: np.isin(codes, [code[name] for name in names])
        pos, before, after = self.codes, self.beside(self.codes, -1, -1), self.beside(self.codes, 1, -1)
        nominal = is_in(pos, "NOUN", "PROPN")
        rules = [
            ("ROOT", self.at == self.root),
            ("punct", pos == code["PUNCT"]),
            ("pobj", nominal & (before == code["ADP"])),
            ("compound", self.proper & (after == code["PROPN"])),
            ("dobj", nominal & (before == code["VERB"])),
            ("nsubj", (nominal | (pos == code["PRON"])) & is_in(after, "VERB", "AUX")),
            ("amod", (pos == code["ADJ"]) & is_in(after, "NOUN", "PROPN")),
            ("advmod", pos == code["ADV"]),
            ("conj", nominal & (before == code["CCONJ"])),
        ]
        found = np.full(self.size, DEPS.index("dep"), np.int8)
        for name, test in reversed(rules):
            found[test] = DEPS.index(name)
        return Coded(found, DEPS)

    def columns(self, fields: list[str], types: list[str] | None = None, **more: Callable[[], pa.Array]) -> pa.StructArray:
        """The named fields of all tokens. Only entities of the given types are kept; ``more`` makes further fields."""
        whole = lambda values, null=None: pa.array(values.astype(np.int32), mask=null)
        first_sentence = lambda: self.messages[:-1][self.message_of]
        made = {
            "token": lambda: self.token,
            "pos": lambda: self.pos.arrow(),
            "tag": lambda: self.tag.arrow(),
            "tag_": lambda: self.tag.arrow(),
            "dep": lambda: self.dep.arrow(),
            "lemma": lambda: self.lemma.arrow(),
            "sent_idx": lambda: whole(self.sentence_of - first_sentence()),
            "token_idx": lambda: whole(self.at - self.message_start),
            "head_off": lambda: whole(self.head - self.at),
            "head_idx": lambda: whole(self.head - self.message_start),
            "ent_pos": lambda: whole(self.ent_pos, ~self.entity(types)),
            "ent_type": lambda: self.ent_type.arrow(~self.proper),
            "is_ent": lambda: whole(self.entity(types)),
        } | more
        return pa.StructArray.from_arrays([made[name]() for name in fields], names=fields)

    def by_message(self, tokens: pa.Array) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(self.sentences[self.messages].astype(np.int32)), tokens)

    def by_sentence(self, tokens: pa.Array) -> pa.ListArray:
        inner = pa.ListArray.from_arrays(pa.array(self.sentences.astype(np.int32)), tokens)
        return pa.ListArray.from_arrays(pa.array(self.messages.astype(np.int32)), inner)


def sliced(column: pa.ListArray, sizes: np.ndarray) -> Iterator[pa.ListArray]:
    """A batch in slices of about ``SLICE_TOKENS`` tokens, given the tokens of each row; one empty slice if it is empty."""
    upto = np.cumsum(sizes)
    cuts = [0, *(np.flatnonzero(np.diff((upto - 1) // SLICE_TOKENS)) + 1).tolist(), len(column)]
    for a, b in zip(cuts, cuts[1:]):
        yield column.slice(a, b - a)


def annotating(make: Callable[[Annotated], pa.Array], kind: str) -> Callable[[str], Column]:
    """A function of a column of words by sentence that makes arrays of type ``kind`` from their annotation.

    The names of the parts of speech come with the rows.
    """

    @F.arrow_udf(kind)
    def annotated(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for words, names in parts:
            lengths = pc.list_value_length(words).fill_null(0).to_numpy(zero_copy_only=False)
            held = np.concatenate([[0], np.cumsum(pc.list_value_length(words.flatten()).to_numpy(zero_copy_only=False))])
            ends = np.cumsum(lengths)
            pos_names = names[0].as_py().split() if len(names) else POS
            made = [make(Annotated(own, pos_names)) for own in sliced(words, held[ends] - held[ends - lengths])]
            yield made[0] if len(made) == 1 else pa.concat_arrays(made)

    return lambda words: annotated(words, F.lit(" ".join(POS)))


def struct_type(fields: list[str]) -> str:
    return f"struct<{', '.join(f'{name}: {TYPES[name]}' for name in fields)}>"


def annotate(
    messages: DataFrame, text: str = "raw_text", max_chars: int | None = None, fields: list[str] | None = None
) -> DataFrame:
    """Add ``sentences``, with all token fields or only the named ones.

    What no named field reads is not looked for. ``max_chars`` keeps only the first characters; by
    default texts stay whole.
    """
    names = [name for name in SENTENCE_FIELDS if name in (fields or SENTENCE_FIELDS)]
    found = annotating(lambda a: a.by_sentence(a.columns(names)), f"array<array<{struct_type(names)}>>")
    return word_sentences_of(messages, text, max_chars).withColumn("sentences", found("_words")).drop("_words")


def annotate_long(
    messages: DataFrame, text: str = "raw_text", max_chars: int | None = None, fields: list[str] | None = None,
    types: list[str] | None = None,
) -> DataFrame:
    """Add ``tokens``: all tokens of a message in order, with position, head position and entity flag.

    Only entities of the given types are kept.
    """
    names = [name for name in LONG_FIELDS if name in (fields or LONG_FIELDS)]
    found = annotating(lambda a: a.by_message(a.columns(names, types)), f"array<{struct_type(names)}>")
    return word_sentences_of(messages, text, max_chars).withColumn("tokens", found("_words")).drop("_words")


def explode_tokens(messages: DataFrame, tokens: str = "tokens", key: str = "message_id") -> DataFrame:
    """One row per token, from an array of token structs."""
    return explode_rows(messages, [key], F.col(tokens), "_t").select(key, "_t.*")


def tokenize(messages: DataFrame, text: str = "raw_text", key: str = "message_id") -> DataFrame:
    """(key, token_idx, token) for every token of the whole text."""
    tokens = F.regexp_extract_all(F.col(text), F.lit(TOKEN_PATTERN), F.lit(0))
    return explode_rows(messages, [key], tokens, "token", "token_idx")


def split_sentences(messages: DataFrame, text: str = "raw_text", key: str = "message_id") -> DataFrame:
    """(key, sent_idx, sentence) for every sentence that is not blank."""
    parts = F.filter(F.split(F.col(text), SENTENCE_BREAK), lambda s: t.strip(s) != "")
    return explode_rows(messages, [key], parts, "sentence", "sent_idx")
