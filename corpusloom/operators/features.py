"""Token features and style features, computed inside the message row."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as w

from corpusloom.functions import text as t
from corpusloom.functions import vocab
from corpusloom.functions.arrays import count_if, explode_rows, let, positions, total
from corpusloom.functions.numeric import half_even, ratio
from corpusloom.lookups import literal_map

TOKEN_FEATURES = [
    "pos_enc", "dep_enc", "prev_pos_enc", "next_pos_enc", "prev_is_prep", "next_is_noun", "is_act_verb",
    "is_loc_word", "is_capitalized", "is_ent", "token_pos_norm", "sentence_len", "is_number",
]
# Token fields the features read.
TOKEN_FIELDS = ["token", "pos", "dep", "lemma", "is_ent"]
STYLE_FEATURES = [
    "avg_sentence_length", "num_sentences", "num_words", "parse_tree_depth", "type_token_ratio", "passive_ratio",
    "hedge_count", "hedge_rate", "discourse_count", "discourse_rate", "avg_word_length", "punct_ratio",
    "pct_noun", "pct_verb", "pct_adj", "pct_adv", "pct_pron",
]


@dataclass(frozen=True)
class FeatureVocabulary:
    """The word lists behind the features."""

    prepositions: list[str] = field(default_factory=lambda: list(vocab.FEATURE_PREPOSITIONS))
    actions: list[str] = field(default_factory=lambda: list(vocab.FEATURE_ACTIONS))
    places: list[str] = field(default_factory=lambda: list(vocab.FEATURE_PLACES))


def fit_encoders(tokens: DataFrame, seed_pos: list[str] = vocab.SEED_POS) -> DataFrame:
    """(kind, value, code): codes are ranks in the sorted vocabulary of pos, dep and bio.

    ``tokens`` has one row per token with pos, dep and bio_tag; ``pos`` also gets the seed values.
    The few combinations that occur are found first, so the shuffle carries some hundred rows per
    task.
    """
    seen = tokens.groupBy(
        F.coalesce("pos", F.lit("X")).alias("pos"), F.coalesce("dep", F.lit("dep")).alias("dep"),
        F.coalesce("bio_tag", F.lit("O")).alias("bio"),
    ).agg(F.count("*").alias("n"))
    values = seen.unpivot([], ["pos", "dep", "bio"], "kind", "value")
    seeds = tokens.sparkSession.createDataFrame([("pos", v) for v in seed_pos], "kind string, value string")
    vocabulary = values.unionByName(seeds).distinct()
    rank = F.row_number().over(w.Window.partitionBy("kind").orderBy("value")) - 1
    return vocabulary.withColumn("code", rank)


def encoder_maps(encoders: DataFrame, max_entries: int = 1000) -> dict[str, Column]:
    """One value-to-code map per kind, as literals. The vocabularies are tag sets; their size is checked."""
    rows = encoders.limit(max_entries + 1).collect()
    if len(rows) > max_entries:
        raise ValueError(f"encoders hold more than {max_entries} values")
    return {k: literal_map({r["value"]: r["code"] for r in rows if r["kind"] == k}) for k in ("pos", "dep", "bio")}


def decoder_map(encoders: DataFrame, kind: str = "bio", max_entries: int = 1000) -> Column:
    """Code to value of one kind, as a literal."""
    rows = encoders.where(F.col("kind") == kind).limit(max_entries + 1).collect()
    if len(rows) > max_entries:
        raise ValueError(f"encoder holds more than {max_entries} values")
    return literal_map({r["code"]: r["value"] for r in rows})


def encode(codes: Column, value: Column, unknown: int = 0) -> Column:
    """The code of a value; an unknown value gets 0, like the first class, unless told otherwise."""
    return F.coalesce(F.element_at(codes, value), F.lit(unknown))


def token_columns(
    messages: DataFrame,
    words: FeatureVocabulary | None = None,
    key: str = "message_id",
    tokens: str = "tokens",
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per token: the features before encoding, with the neighbours' part of speech.

    Neighbours are read inside the message row, from arrays shifted by one; all else is worked out on
    the rows of tokens, where Spark compiles it. ``bio_tag`` is there when tokens carry a label, and
    ``keep`` names further token fields to carry along.
    """
    words = words or FeatureVocabulary()
    fields = messages.schema[tokens].dataType.elementType.names
    carried = [name for name in fields if name in ["bio_tag"] + (keep or []) and name not in ("pos", "dep")]

    def flag(test: Column) -> Column:
        return F.coalesce(test, F.lit(False)).cast("int")

    toks, n, none = F.col(tokens), F.size(tokens), F.array(F.lit("X"))
    pos, lemmas = F.transform(toks, lambda tok: F.coalesce(tok["pos"], F.lit("X"))), toks["lemma"]
    beside = F.arrays_zip(
        toks.alias("tok"),
        F.slice(F.concat(none, pos), F.lit(1), n).alias("prev_pos"),
        F.slice(F.concat(pos, none), F.lit(2), n).alias("next_pos"),
        F.slice(F.concat(F.array(F.lit(None).cast("string")), lemmas), F.lit(1), n).alias("prev_lemma"),
    )
    rows = explode_rows(messages.withColumn("_n", n), [key, "_n"], beside, "_z", "token_idx")
    tok = F.col("_z.tok")
    return rows.select(
        key,
        "token_idx",
        F.coalesce(tok["pos"], F.lit("X")).alias("pos"),
        F.coalesce(tok["dep"], F.lit("dep")).alias("dep"),
        F.col("_z.prev_pos").alias("prev_pos"),
        F.col("_z.next_pos").alias("next_pos"),
        flag(F.col("_z.prev_lemma").isin(words.prepositions)).alias("prev_is_prep"),
        flag(tok["lemma"].isin(words.actions)).alias("is_act_verb"),
        flag(tok["lemma"].isin(words.places)).alias("is_loc_word"),
        flag(t.is_capitalised(tok["token"])).alias("is_capitalized"),
        tok["is_ent"].alias("is_ent"),
        F.col("_n").alias("n_tokens"),
        flag(t.is_numeric(tok["token"])).alias("is_number"),
        *[tok[name].alias(name) for name in carried],
    )


def encode_tokens(
    rows: DataFrame, encoders: dict[str, Column], unknown: int = 0, key: str = "message_id", keep: list[str] | None = None
) -> DataFrame:
    """Key, token_idx, the 13 features and ``bio_enc`` where there is a label."""
    pos = lambda name: encode(encoders["pos"], F.col(name), unknown)
    place = F.col("token_idx") / F.greatest(F.col("n_tokens") - 1, F.lit(1))
    made = {
        "pos_enc": pos("pos"),
        "dep_enc": encode(encoders["dep"], F.col("dep"), unknown),
        "prev_pos_enc": pos("prev_pos"),
        "next_pos_enc": pos("next_pos"),
        "next_is_noun": F.col("next_pos").isin("NOUN", "PROPN").cast("int"),
        "token_pos_norm": half_even(place, 4),
        "sentence_len": half_even(F.col("n_tokens") / 50.0, 4),
    }
    columns = [made.get(name, F.col(name)).alias(name) for name in TOKEN_FEATURES]
    if "bio_tag" in rows.columns:
        columns.append(encode(encoders["bio"], F.col("bio_tag"), unknown).alias("bio_enc"))
    return rows.select(key, "token_idx", *columns, *(keep or []))


def token_features(
    messages: DataFrame,
    encoders: dict[str, Column],
    words: FeatureVocabulary | None = None,
    key: str = "message_id",
    tokens: str = "tokens",
    unknown: int = 0,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per token with its features, for encoders that are fitted already."""
    return encode_tokens(token_columns(messages, words, key, tokens, keep), encoders, unknown, key, keep)


def sentence_depth(sentence: Column) -> Column:
    """Depth of the tree under the first root of one sentence; null when there is no root.

    Pointer doubling: in every round a token jumps as far as its target jumps, so the rounds grow
    with the logarithm of the sentence length.
    """
    heads = F.transform(sentence, lambda tok, i: i + tok["head_off"])

    def measured(h: Column) -> Column:
        first = F.transform(h, lambda j, i: F.when(j == i, 0).otherwise(1))
        rounds = F.sequence(F.lit(1), F.ceil(F.log2(F.size(h) + 1)).cast("int"))
        state = F.struct(h.alias("jump"), first.alias("far"))
        done = F.aggregate(
            rounds,
            state,
            lambda s, _: F.struct(
                F.transform(s["jump"], lambda j: F.get(s["jump"], j)).alias("jump"),
                F.zip_with(s["far"], s["jump"], lambda d, j: d + F.get(s["far"], j)).alias("far"),
            ),
        )
        root = F.array_min(F.filter(positions(h), lambda i: F.get(h, i) == i))
        under = lambda s: F.zip_with(s["far"], s["jump"], lambda d, j: F.when(j == root, d))
        return let(done, lambda s: F.array_max(under(s)) + 1)

    return let(heads, measured)


def style_features(
    responses: DataFrame,
    text: str = "response_text",
    hedges: list[str] = vocab.HEDGES,
    discourse: list[str] = vocab.DISCOURSE,
    sentences: str = "sentences",
) -> DataFrame:
    """Replace ``sentences`` by the 17 style features of the response."""
    stripped = F.coalesce(F.col(text), F.lit(""))

    def has(sentence: Column, test) -> Column:
        return F.exists(sentence, test)

    def has_pos(pos: str):
        return lambda tok: tok["pos"] == pos

    def measured(sents: Column, toks: Column, words: Column, lemmas: Column, depths: Column) -> Column:
        n = F.size(words)
        n_sents = F.greatest(F.size(sents), F.lit(1))
        with_verb = F.filter(sents, lambda s: has(s, lambda tok: tok["pos"] == "VERB"))
        passive = count_if(
            with_verb, lambda s: has(s, lambda tok: (tok["dep"] == "nsubjpass") | (tok["tag"] == "VBN"))
        )
        hedge, marker = F.col("_hedges"), F.col("_markers")
        letters = total(F.transform(words, lambda tok: F.length(tok["token"])))
        share = {
            f"pct_{p.lower()}": ratio(count_if(words, has_pos(p)), n)
            for p in ("NOUN", "VERB", "ADJ", "ADV", "PRON")
        }
        values = {
            "avg_sentence_length": n / n_sents,
            "num_sentences": n_sents,
            "num_words": n,
            "parse_tree_depth": ratio(total(depths), F.size(depths)),
            "type_token_ratio": ratio(F.size(F.array_distinct(lemmas)), F.size(lemmas)),
            "passive_ratio": ratio(passive, F.size(with_verb)),
            "hedge_count": hedge,
            "hedge_rate": ratio(hedge, n),
            "discourse_count": marker,
            "discourse_rate": ratio(marker, n),
            "avg_word_length": ratio(letters, n),
            "punct_ratio": ratio(count_if(toks, lambda tok: tok["pos"] == "PUNCT"), F.size(toks)),
            **share,
        }
        return F.struct(*[values[name].alias(name) for name in STYLE_FEATURES])

    features = let(
        F.col(sentences),
        lambda sents: let(
            F.flatten(sents),
            lambda toks: let(
                F.struct(
                    F.filter(toks, lambda tok: tok["pos"] != "PUNCT").alias("w"),
                    F.filter(F.transform(sents, sentence_depth), lambda d: d.isNotNull()).alias("d"),
                ),
                lambda p: let(
                    F.transform(
                        F.filter(p["w"], lambda tok: t.is_alphabetic(tok["token"])), lambda tok: tok["lemma"]
                    ),
                    lambda lemmas: measured(sents, toks, p["w"], lemmas, p["d"]),
                ),
            ),
        ),
    )
    counted = responses.withColumn("_hedges", t.phrase_count(stripped, hedges)).withColumn(
        "_markers", t.phrase_count(stripped, discourse)
    )
    kept = [c for c in responses.columns if c != sentences]
    return counted.select(*kept, features.alias("_style")).select(*kept, "_style.*")


def join_labels(features: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """Features with their labels, by key and never by row position."""
    return features.join(labels, keys)
