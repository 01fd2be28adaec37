"""The stemming steps in DuckDB SQL, for the check of word stems."""

from corpusloom.functions import stemming as st


def _case_map(column: str, pairs: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items()) + " END"


def _m(word: str, pattern: str) -> str:
    return f"regexp_matches({word}, '{pattern}')"


def _cut(word: str, n: int) -> str:
    return f"substr({word}, 1, greatest(length({word}) - {n}, 0))"


def _mapped(source: str, target: str, endings: dict[str, str], first: str = "") -> str:
    """One step that swaps the longest listed ending when the part before it has measure 1 or more."""
    pattern = "^(.*?)(" + "|".join(endings) + ")$"
    return f"""
  {target}_e AS (SELECT *, regexp_extract(w, '{pattern}', 1) AS b, regexp_extract(w, '{pattern}', 2) AS e FROM {source}),
  {target} AS (SELECT word, n, CASE {first} WHEN e <> '' AND {_m('b', st.MEASURE_1_UP)} THEN b || {_case_map('e', endings)} ELSE w END AS w FROM {target}_e),"""


_FOURTH = "^(.*?)(" + "|".join(st.FOURTH_STEP) + ")$"
_DOUBLED = "right(s, 1) = substr(s, -2, 1) AND length(s) >= 2 AND regexp_matches(s, '[^aeiouy]$')"
_LOGI = f"WHEN ends_with(w, 'logi') THEN CASE WHEN {_m(_cut('w', 3), st.MEASURE_1_UP)} THEN {_cut('w', 1)} ELSE w END"

PORTER_SQL = (
    f"""
  WITH words AS ({{words}}),
  p0 AS (SELECT word, n, CASE WHEN {_m('word', '^.ies$')} THEN {_cut('word', 1)} WHEN {_m('word', '(sses|ies)$')} THEN {_cut('word', 2)}
                WHEN {_m('word', '([^s]s$)|(^s$)')} THEN {_cut('word', 1)} ELSE word END AS w FROM words),
  p1 AS (SELECT *, CASE WHEN {_m('w', '(ed|ing)$')} AND NOT {_m('w', '(ied|eed)$')}
                    AND {_m("regexp_replace(w, '(ed|ing)$', '')", st.HAS_VOWEL)} THEN regexp_replace(w, '(ed|ing)$', '') END AS s FROM p0),
  p2 AS (SELECT word, n, CASE
           WHEN {_m('w', '^.ied$')} THEN {_cut('w', 1)} WHEN {_m('w', 'ied$')} THEN {_cut('w', 2)}
           WHEN {_m('w', 'eed$')} THEN CASE WHEN {_m(_cut('w', 3), st.MEASURE_1_UP)} THEN {_cut('w', 1)} ELSE w END
           WHEN s IS NULL THEN w
           WHEN {_m('s', '(at|bl|iz)$')} THEN s || 'e'
           WHEN {_DOUBLED} THEN CASE WHEN {_m('s', '[lsz]$')} THEN s ELSE {_cut('s', 1)} END
           WHEN {_m('s', st.MEASURE_IS_1)} AND {_m('s', st.SHORT_END)} THEN s || 'e' ELSE s END AS w FROM p1),
  p3 AS (SELECT word, n, CASE WHEN {_m('w', '.[^aeiouy]y$')} THEN {_cut('w', 1)} || 'i' ELSE w END AS w FROM p2),
  p4 AS (SELECT word, n, CASE WHEN ends_with(w, 'alli') AND {_m(_cut('w', 4), st.MEASURE_1_UP)} THEN {_cut('w', 2)} ELSE w END AS w FROM p3),"""
    + _mapped("p4", "p5", st.SECOND_STEP, _LOGI)
    + _mapped("p5", "p6", st.THIRD_STEP)
    + f"""
  p7_e AS (SELECT *, regexp_extract(w, '{_FOURTH}', 1) AS b, regexp_extract(w, '{_FOURTH}', 2) AS e FROM p6),
  p7 AS (SELECT word, n, CASE WHEN e <> '' AND {_m('b', st.MEASURE_2_UP)} AND (e <> 'ion' OR {_m('b', '[st]$')}) THEN b ELSE w END AS w FROM p7_e),
  p8 AS (SELECT word, n, CASE WHEN ends_with(w, 'e') AND ({_m(_cut('w', 1), st.MEASURE_2_UP)} OR
                ({_m(_cut('w', 1), st.MEASURE_IS_1)} AND NOT {_m(_cut('w', 1), st.SHORT_END)})) THEN {_cut('w', 1)} ELSE w END AS w FROM p7),
  p9 AS (SELECT word, n, CASE WHEN ends_with(w, 'll') AND {_m(_cut('w', 1), st.MEASURE_2_UP)} THEN {_cut('w', 1)} ELSE w END AS w FROM p8),
  stems AS (SELECT word, n, coalesce({_case_map('word', st.IRREGULAR)}, CASE WHEN length(word) <= 2 THEN word END, w) AS stem FROM p9)
"""
)
