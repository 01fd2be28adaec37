"""Porter (1980) stemming as Column expressions, with the later extensions of the algorithm.

Words are sequences [C](VC)^m[V]; the patterns below test m on the part before a suffix. The
extensions are: words of two letters stay, a few irregular forms, ``ies``/``ied`` in words of four
letters, ``y`` after any consonant, and the endings ``bli``, ``fulli`` and ``logi``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.lookups import literal_map

_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
HAS_VOWEL = f"^({_C})?[aeiouy]"
MEASURE_1_UP = f"^({_C})?{_V}{_C}"
MEASURE_2_UP = f"^({_C})?{_V}{_C}{_V}{_C}"
MEASURE_IS_1 = f"^({_C})?{_V}{_C}({_V})?$"
SHORT_END = f"(^{_C}[aeiouy][^aeiouwxy]$)|(^[aeiou][^aeiou]$)"

# Irregular forms.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
# Suffix replacements of the second and third step.
SECOND_STEP = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate",
    "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive",
    "biliti": "ble", "fulli": "ful",
}
THIRD_STEP = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
# Suffixes cut in the fourth step.
FOURTH_STEP = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


def _cut(word: Column, letters: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - letters)


def _plural(w: Column) -> Column:
    return (
        F.when(w.rlike("^.ies$"), _cut(w, 1))
        .when(w.rlike("(sses|ies)$"), _cut(w, 2))
        .when(w.rlike("[^s]s$|^s$"), _cut(w, 1))
        .otherwise(w)
    )


def _past_stem(w: Column) -> Column:
    """The word without -ed or -ing when a vowel is left, else null."""
    stem = F.regexp_replace(w, "(ed|ing)$", "")
    return F.when(w.rlike("(ed|ing)$") & ~w.rlike("(ied|eed)$") & stem.rlike(HAS_VOWEL), stem)


def _past(w: Column, stem: Column) -> Column:
    doubled = (F.substring(stem, -1, 1) == F.substring(stem, -2, 1)) & (F.length(stem) >= 2) & stem.rlike("[^aeiouy]$")
    repaired = (
        F.when(stem.rlike("(at|bl|iz)$"), F.concat(stem, F.lit("e")))
        .when(doubled, F.when(stem.rlike("[lsz]$"), stem).otherwise(_cut(stem, 1)))
        .when(stem.rlike(MEASURE_IS_1) & stem.rlike(SHORT_END), F.concat(stem, F.lit("e")))
        .otherwise(stem)
    )
    return (
        F.when(w.rlike("^.ied$"), _cut(w, 1))
        .when(w.rlike("ied$"), _cut(w, 2))
        .when(w.rlike("eed$"), F.when(_cut(w, 3).rlike(MEASURE_1_UP), _cut(w, 1)).otherwise(w))
        .otherwise(F.coalesce(repaired, w))
    )


def _final_y(w: Column) -> Column:
    return F.when(w.rlike(".[^aeiouy]y$"), F.concat(_cut(w, 1), F.lit("i"))).otherwise(w)


def _alli(w: Column) -> Column:
    return F.when(w.rlike("alli$") & _cut(w, 4).rlike(MEASURE_1_UP), _cut(w, 2)).otherwise(w)


def _mapped(w: Column, endings: dict[str, str]) -> Column:
    pattern = "^(.*?)(" + "|".join(endings) + ")$"
    ending = F.regexp_extract(w, pattern, 2)
    before = F.regexp_extract(w, pattern, 1)
    return F.when((ending != "") & before.rlike(MEASURE_1_UP), F.concat(before, literal_map(endings)[ending])).otherwise(w)


def _second(w: Column) -> Column:
    return (
        F.when(w.rlike("logi$"), F.when(_cut(w, 3).rlike(MEASURE_1_UP), _cut(w, 1)).otherwise(w))
        .otherwise(_mapped(w, SECOND_STEP))
    )


def _fourth(w: Column) -> Column:
    pattern = "^(.*?)(" + "|".join(FOURTH_STEP) + ")$"
    ending = F.regexp_extract(w, pattern, 2)
    before = F.regexp_extract(w, pattern, 1)
    fits = before.rlike(MEASURE_2_UP) & ((ending != "ion") | before.rlike("[st]$"))
    return F.when((ending != "") & fits, before).otherwise(w)


def _fifth(w: Column) -> Column:
    stem = _cut(w, 1)
    keep_e = ~stem.rlike(MEASURE_2_UP) & ~(stem.rlike(MEASURE_IS_1) & ~stem.rlike(SHORT_END))
    without_e = F.when(w.rlike("e$") & ~keep_e, stem).otherwise(w)
    return without_e


def _double_l(w: Column) -> Column:
    return F.when(w.rlike("ll$") & _cut(w, 1).rlike(MEASURE_2_UP), _cut(w, 1)).otherwise(w)


def add_stems(words: DataFrame, word: str = "word", name: str = "stem") -> DataFrame:
    """Add the stem of every word. Give it distinct words: each step is a handful of patterns."""
    low = F.lower(F.col(word))
    short = F.length(low) <= 2
    irregular = literal_map(IRREGULAR)[low]
    step = words.withColumn("_w", _plural(low))
    step = step.withColumn("_s", _past_stem(F.col("_w")))
    step = step.withColumn("_w", _past(F.col("_w"), F.col("_s")))
    step = step.withColumn("_w", _final_y(F.col("_w")))
    step = step.withColumn("_w", _alli(F.col("_w")))
    for rule in (_second, lambda w: _mapped(w, THIRD_STEP), _fourth, _fifth, _double_l):
        step = step.withColumn("_w", rule(F.col("_w")))
    return step.withColumn(name, F.coalesce(irregular, F.when(short, low), F.col("_w"))).drop("_w", "_s")
