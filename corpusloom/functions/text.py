"""Scalar text functions as Column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import vocab

#: White space of any kind: as characters, and as a class for patterns.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def text_or_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def long_enough(text: Column, more_than: int) -> Column:
    """More than ``more_than`` characters are left after stripping."""
    return F.length(strip(text)) > more_than


def prefixed_id(raw_id: Column, prefix: str = "KG", digits: int = 5) -> Column:
    """``KG_00007`` for an all-digit id, any other id as it is. Long ids keep all their digits."""
    text = raw_id.cast("string")
    numeric = F.format_string(f"{prefix}_%0{digits}d", F.try_to_number(text, F.lit("9" * 18)).cast("long"))
    return F.when(text.rlike(r"^\d{1,18}$"), numeric).when(
        text.rlike(r"^\d+$"), F.concat(F.lit(prefix + "_"), text)
    ).otherwise(text)


def running_id(position: Column, prefix: str, digits: int = 4) -> Column:
    """``AI_0001`` from a one-based position."""
    return F.format_string(f"{prefix}_%0{digits}d", position.cast("long"))


def normalised_label(label: Column) -> Column:
    """Strip, then ``Human`` to ``human`` and every substring ``ai`` to ``AI``."""
    human = F.replace(strip(label), F.lit("Human"), F.lit("human"))
    return F.replace(human, F.lit("ai"), F.lit("AI"))


def ticket_text(kind: Column, subject: Column, body: Column, strip_parts: bool = False) -> Column:
    """``[type] subject | body`` with nulls as blanks; scoring also strips each part."""
    part = (lambda c: strip(text_or_blank(c))) if strip_parts else text_or_blank
    return strip(F.concat(F.lit("["), part(kind), F.lit("] "), part(subject), F.lit(" | "), part(body)))


def blank(text: Column) -> Column:
    return strip(text_or_blank(text)) == ""


def split_words(text: Column) -> Column:
    """Lower-cased words between runs of white space."""
    return F.filter(F.split(F.lower(text), SPACE + "+"), lambda w: w != "")


def phrase_count(text: Column, phrases: list[str]) -> Column:
    """Non-overlapping count of phrases with a blank on either side, added over the phrases.

    A phrase next to punctuation does not count, and two neighbouring copies that share one blank
    count once.
    """
    padded = F.concat(F.lit(" "), F.lower(strip(text)), F.lit(" "))

    def count(phrase: str) -> Column:
        needle = f" {phrase} "
        rest = F.length(F.replace(padded, F.lit(needle), F.lit("")))
        return ((F.length(padded) - rest) / len(needle)).cast("int")

    return reduce(lambda a, b: a + b, [count(p) for p in phrases], F.lit(0))


def longest_first(affixes: list[str]) -> list[str]:
    """Longest affix first; equal lengths keep their order."""
    return sorted(affixes, key=len, reverse=True)


def first_prefix(word: Column, prefixes: list[str] = vocab.PREFIXES) -> Column:
    """The first fitting prefix that leaves more than one character; null when there is none."""
    tests = [
        F.when(F.startswith(word, F.lit(a)) & (F.length(word) > len(a) + 1), F.lit(a))
        for a in longest_first(prefixes)
    ]
    return F.coalesce(*tests)


def first_suffix(word: Column, suffixes: list[str] = vocab.SUFFIXES) -> Column:
    """The first fitting suffix that leaves more than one character; null when there is none."""
    tests = [
        F.when(F.endswith(word, F.lit(a)) & (F.length(word) > len(a) + 1), F.lit(a))
        for a in longest_first(suffixes)
    ]
    return F.coalesce(*tests)


def affix_class(prefix: Column, suffix: Column, short: bool = False) -> Column:
    """Say in words which affixes were found, in the long or the short spelling."""
    both = "both ('%s' + '%s')" if short else "both prefix ('%s') and suffix ('%s')"
    return (
        F.when(prefix.isNotNull() & suffix.isNotNull(), F.format_string(both, prefix, suffix))
        .when(prefix.isNotNull(), F.format_string("prefix ('%s')", prefix))
        .when(suffix.isNotNull(), F.format_string("suffix ('%s')", suffix))
        .otherwise("neither")
    )


def small_first(token: Column) -> Column:
    """The first byte is one of a-z, which is seen without a pattern."""
    return (token >= "a") & (token < "{")


def is_capitalised(token: Column) -> Column:
    return ~small_first(token) & token.rlike(r"^\p{Lu}")


def is_numeric(token: Column) -> Column:
    """Only digits are left, and at least one, when points and commas are taken out."""
    return ~small_first(token) & F.regexp_replace(token, "[.,]", "").rlike(r"^\p{Nd}+$")


def is_alphabetic(token: Column) -> Column:
    return token.rlike(r"^\p{L}+$")


def is_punctuation(token: Column) -> Column:
    return token.rlike(r"^\p{P}+$")


def is_space(token: Column) -> Column:
    return token.rlike(f"^{SPACE}+$")


def credential_class(
    key: Column,
    shapes: list[tuple[str, int]] = vocab.KEY_SHAPES,
    placeholders: list[str] = vocab.KEY_PLACEHOLDERS,
    client_prefix: str = vocab.CLIENT_ID_PREFIX,
) -> Column:
    """Name the shape of a credential: missing, placeholder, client_id, valid or invalid."""
    valid = [F.startswith(key, F.lit(p)) & (F.length(key) >= n) for p, n in shapes]
    return (
        F.when(text_or_blank(key) == "", "missing")
        .when(key.isin(placeholders), "placeholder")
        .when(F.startswith(key, F.lit(client_prefix)), "client_id")
        .when(reduce(lambda a, b: a | b, valid), "valid")
        .otherwise("invalid")
    )


def clean_credential(raw: Column) -> Column:
    """Strip white space, then double, then single quotation marks."""
    return F.btrim(F.btrim(strip(text_or_blank(raw)), F.lit('"')), F.lit("'"))


def outcome_class(message: Column) -> Column:
    """Class of an error text: bad_key, quota, model_missing or other; null text is ok."""
    return (
        F.when(message.isNull(), "ok")
        .when(message.contains("API_KEY_INVALID") | message.contains("API key not valid"), "bad_key")
        .when(message.contains("429") | message.contains("RESOURCE_EXHAUSTED"), "quota")
        .when(message.contains("404") & F.lower(message).contains("model"), "model_missing")
        .otherwise("other")
    )


def fill(template: str, **values: Column) -> Column:
    """Replace ``{name}`` in the template by the column given for it; braces inside the columns stay as they are."""
    if not values:
        return F.lit(template)
    parts = re.split(r"\{(" + "|".join(values) + r")\}", template)
    return F.concat(*[values[part] if i % 2 else F.lit(part) for i, part in enumerate(parts)])
