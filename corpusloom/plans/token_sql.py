"""The annotator, the span rules and the style features in DuckDB SQL, for the checks."""

from __future__ import annotations

from corpusloom.functions import vocab
from corpusloom.operators.tagging import SpanVocabulary


def listed(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def annotated_sql(source: str) -> str:
    """CTEs ending in ``ann``, from a query that yields (message_id, raw_text)."""
    verbs = listed(vocab.BASE_VERBS)
    return rf"""
  src AS ({source}),
  ex AS (SELECT message_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS p FROM (
    SELECT message_id, regexp_extract_all(raw_text, '[\p{{L}}\p{{N}}]+|[^\s\p{{L}}\p{{N}}]|\s+') AS toks FROM src)),
  mk AS (SELECT *, regexp_full_match(tok, '\s+') AS ws, lag(tok) OVER (PARTITION BY message_id ORDER BY p) AS ptok FROM ex),
  br AS (SELECT *, sum(CASE WHEN ws AND ptok IN ('.', '!', '?') THEN 1 ELSE 0 END) OVER (PARTITION BY message_id ORDER BY p) AS s0 FROM mk),
  tk AS (SELECT message_id, tok AS token, lower(tok) AS low, row_number() OVER (PARTITION BY message_id ORDER BY p) - 1 AS token_idx,
                s0 FROM br WHERE NOT ws),
  sn AS (SELECT *, dense_rank() OVER (PARTITION BY message_id ORDER BY s0) - 1 AS sent_idx FROM tk),
  si AS (SELECT *, row_number() OVER (PARTITION BY message_id, sent_idx ORDER BY token_idx) - 1 AS i FROM sn),
  ps AS (SELECT *, CASE
      WHEN regexp_matches(token, '^\p{{N}}+$') THEN 'NUM' WHEN regexp_matches(token, '^\p{{P}}$') THEN 'PUNCT'
      WHEN NOT regexp_matches(token, '^[\p{{L}}\p{{N}}]') THEN 'SYM'
      WHEN low IN ({listed(vocab.ADPOSITIONS)}) THEN 'ADP' WHEN low IN ({listed(vocab.DETERMINERS)}) THEN 'DET'
      WHEN low IN ({listed(vocab.PRONOUNS)}) THEN 'PRON' WHEN low IN ({listed(vocab.AUXILIARIES)}) THEN 'AUX'
      WHEN low IN ({listed(vocab.CONJUNCTIONS)}) THEN 'CCONJ' WHEN low IN ({listed(vocab.verb_forms())}) THEN 'VERB'
      WHEN i > 0 AND regexp_matches(token, '^\p{{Lu}}') THEN 'PROPN'
      WHEN regexp_matches(low, '^...*(ing|ed)$') THEN 'VERB' WHEN regexp_matches(low, '^..*ly$') THEN 'ADV'
      WHEN regexp_matches(low, '^..*(ful|less|able|ous)$') THEN 'ADJ' ELSE 'NOUN' END AS pos FROM si),
  nb AS (SELECT *, coalesce(lag(pos) OVER s, '') AS before, coalesce(lead(pos) OVER s, '') AS after, lag(low) OVER s AS plow,
      max(CASE WHEN pos = 'VERB' THEN token_idx END) OVER (s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_verb,
      coalesce(min(CASE WHEN pos = 'VERB' THEN token_idx END) OVER (PARTITION BY message_id, sent_idx),
               min(token_idx) OVER (PARTITION BY message_id, sent_idx)) AS root,
      sum(CASE WHEN pos <> 'PROPN' THEN 1 ELSE 0 END) OVER (s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
      regexp_replace(low, '(ing|ed|es|s)$', '') AS stem
    FROM ps WINDOW s AS (PARTITION BY message_id, sent_idx ORDER BY token_idx)),
  an0 AS (SELECT *, (pos = 'PROPN') AS propn, CASE
      WHEN token_idx = root THEN 'ROOT' WHEN pos = 'PUNCT' THEN 'punct'
      WHEN pos IN ('NOUN', 'PROPN') AND before = 'ADP' THEN 'pobj' WHEN pos = 'PROPN' AND after = 'PROPN' THEN 'compound'
      WHEN pos IN ('NOUN', 'PROPN') AND before = 'VERB' THEN 'dobj'
      WHEN pos IN ('NOUN', 'PROPN', 'PRON') AND after IN ('VERB', 'AUX') THEN 'nsubj'
      WHEN pos = 'ADJ' AND after IN ('NOUN', 'PROPN') THEN 'amod' WHEN pos = 'ADV' THEN 'advmod'
      WHEN pos IN ('NOUN', 'PROPN') AND before = 'CCONJ' THEN 'conj' ELSE 'dep' END AS dep,
    CASE WHEN pos = 'NOUN' THEN CASE WHEN regexp_matches(low, '...ies$') THEN regexp_replace(low, 'ies$', 'y')
           WHEN regexp_matches(low, '(ss|us|is)$') THEN low WHEN regexp_matches(low, '...s$') THEN regexp_replace(low, 's$', '') ELSE low END
         WHEN pos = 'VERB' THEN CASE WHEN low IN ({verbs}) THEN low WHEN stem IN ({verbs}) THEN stem
           WHEN stem || 'e' IN ({verbs}) THEN stem || 'e' WHEN substr(stem, 1, length(stem) - 1) IN ({verbs}) THEN substr(stem, 1, length(stem) - 1)
           WHEN length(stem) >= 3 THEN stem ELSE low END
         WHEN pos = 'AUX' AND low IN ({listed(vocab.BE_FORMS)}) THEN 'be' ELSE low END AS lemma,
    CASE WHEN pos = 'VERB' THEN CASE WHEN low IN ({verbs}) THEN 'VB' WHEN regexp_matches(low, 'ing$') THEN 'VBG'
           WHEN regexp_matches(low, 'ed$') THEN CASE WHEN plow IN ({listed(vocab.BE_FORMS)}) THEN 'VBN' ELSE 'VBD' END
           WHEN regexp_matches(low, 's$') THEN 'VBZ' ELSE 'VBD' END
         WHEN pos = 'NOUN' THEN CASE WHEN regexp_matches(low, '[^su]s$') THEN 'NNS' ELSE 'NN' END
         ELSE coalesce(CASE pos WHEN 'PROPN' THEN 'NNP' WHEN 'PUNCT' THEN '.' WHEN 'ADP' THEN 'IN' WHEN 'DET' THEN 'DT' WHEN 'PRON' THEN 'PRP'
           WHEN 'AUX' THEN 'MD' WHEN 'CCONJ' THEN 'CC' WHEN 'NUM' THEN 'CD' WHEN 'ADV' THEN 'RB' WHEN 'ADJ' THEN 'JJ' END, 'SYM') END AS tag_,
    CASE WHEN token_idx = root THEN token_idx ELSE coalesce(last_verb, root) END AS head_idx FROM nb),
  ann AS MATERIALIZED (SELECT message_id, CAST(token_idx AS INT) AS token_idx, CAST(sent_idx AS INT) AS sent_idx, token, pos, tag_, dep, lemma,
      CAST(head_idx AS INT) AS head_idx,
      CAST(CASE WHEN propn THEN row_number() OVER (PARTITION BY message_id, sent_idx, run, propn ORDER BY token_idx) - 1 END AS INT) AS ent_pos,
      CAST(propn AS INT) AS is_ent,
      CASE WHEN propn THEN CASE WHEN last_value(low) OVER (PARTITION BY message_id, sent_idx, run, propn ORDER BY token_idx
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) IN ({listed(vocab.ORG_WORDS)}) THEN 'ORG' ELSE 'GPE' END END AS ent_type
    FROM an0)"""


def tagged_sql(words: SpanVocabulary) -> str:
    """CTEs from ``ann`` to ``bio``. States are chained only from one fixed state to the next."""
    places, actions, preps = listed(words.places), listed(words.actions), listed(words.prepositions)
    place = f"lemma IN ({places})"
    r4 = f"({place} AND pos IN ('NOUN', 'PROPN') AND dep IN ({listed(vocab.PLACE_WORD_DEPS)}))"
    r5 = f"(lemma IN ({actions}) OR (pos = 'VERB' AND dep = 'ROOT' AND tag_ IN ({listed(vocab.FINITE_TAGS)})))"
    r3 = f"(dep IN ({listed(vocab.PLACE_INNER_DEPS)}) OR pos = 'NUM' OR {place} OR token IN ({listed(vocab.PLACE_JOINERS)}))"
    r6 = f"(dep IN ({listed(vocab.ACTION_INNER_DEPS)}) AND pos IN ({listed(vocab.ACTION_INNER_POS)}))"
    ent = f"WHEN ent_type IN ({listed(words.entity_types)}) THEN CASE WHEN ent_pos = 0 THEN 2 ELSE 3 END"
    return f"""
  oc AS (SELECT *,
      CASE {ent} WHEN plem IN ({preps}) THEN CASE WHEN pos IN ({listed(vocab.PLACE_HEAD_POS)}) THEN 2 ELSE 1 END
           WHEN {r4} THEN 2 WHEN {r5} THEN 4 ELSE 1 END AS fo,
      CASE {ent} WHEN {r3} THEN 3 ELSE 1 END AS fl,
      CASE {ent} WHEN {r4} THEN 2 WHEN {r5} THEN 4 WHEN {r6} THEN 5 ELSE 1 END AS fa
    FROM (SELECT *, coalesce(lag(lemma) OVER (PARTITION BY message_id ORDER BY token_idx), '') AS plem FROM ann)),
  rn AS (SELECT *, sum(CAST(token_idx = 0 OR (fo // 2 = fl // 2 AND fl // 2 = fa // 2) AS INT))
                   OVER (PARTITION BY message_id ORDER BY token_idx) AS run FROM oc),
  ch AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY message_id, run ORDER BY token_idx) - 1 AS k FROM rn),
  rec AS (SELECT message_id, run, k, fo // 2 AS state FROM ch WHERE k = 0
    UNION ALL
    SELECT c.message_id, c.run, c.k, CASE r.state WHEN 0 THEN c.fo // 2 WHEN 1 THEN c.fl // 2 ELSE c.fa // 2 END
    FROM rec r JOIN ch c ON c.message_id = r.message_id AND c.run = r.run AND c.k = r.k + 1),
  fin AS (SELECT ch.*, coalesce(lag(state) OVER (PARTITION BY ch.message_id ORDER BY token_idx), 0) AS pstate
          FROM ch JOIN rec ON ch.message_id = rec.message_id AND ch.run = rec.run AND ch.k = rec.k),
  bio AS MATERIALIZED (SELECT message_id, token_idx, sent_idx, token, pos, tag_, dep, lemma, head_idx, ent_pos, is_ent, ent_type,
      (['O', 'B-LOC', 'I-LOC', 'B-ACT', 'I-ACT'])[CASE pstate WHEN 0 THEN fo WHEN 1 THEN fl ELSE fa END] AS bio_tag FROM fin)"""


def style_sql(hedges: str, discourse: str) -> str:
    """CTEs from ``src`` and ``ann`` to ``style``; the arguments are phrase counts over ``raw_text``."""
    return rf"""
  ss AS (SELECT message_id, sent_idx, count(*) AS n, count_if(pos = 'VERB') AS nv, bool_or(tag_ = 'VBN' OR dep = 'nsubjpass') AS passive,
      max(token_idx) AS hi, min(token_idx) AS lo, max(CASE WHEN pos = 'VERB' THEN token_idx END) AS last_v,
      min(CASE WHEN pos = 'VERB' THEN token_idx END) AS first_v FROM ann GROUP BY ALL),
  sd AS (SELECT message_id, count(*) AS num_sentences, avg(CASE WHEN nv = 0 THEN CASE WHEN n > 1 THEN 2 ELSE 1 END
      ELSE 1 + greatest(nv - 1, CASE WHEN hi > last_v THEN nv ELSE 0 END, CASE WHEN lo < first_v THEN 1 ELSE 0 END) END) AS parse_tree_depth,
      count_if(nv > 0) AS verbal, count_if(nv > 0 AND passive) AS passive FROM ss GROUP BY message_id),
  wd AS (SELECT message_id, count(*) AS n_tok, count_if(pos = 'PUNCT') AS n_punct, count_if(pos <> 'PUNCT') AS num_words,
      sum(CASE WHEN pos <> 'PUNCT' THEN length(token) END) AS letters,
      count(DISTINCT CASE WHEN pos <> 'PUNCT' AND regexp_matches(token, '^\p{{L}}+$') THEN lemma END) AS types,
      count_if(pos <> 'PUNCT' AND regexp_matches(token, '^\p{{L}}+$')) AS alphas,
      count_if(pos = 'NOUN') AS nn, count_if(pos = 'VERB') AS vb, count_if(pos = 'ADJ') AS jj, count_if(pos = 'ADV') AS rb,
      count_if(pos = 'PRON') AS pr FROM ann GROUP BY message_id),
  style AS (SELECT src.message_id, src.source_type,
      CASE WHEN num_words IS NULL THEN 0 ELSE num_words / num_sentences END AS avg_sentence_length,
      CAST(coalesce(num_sentences, 1) AS INT) AS num_sentences, CAST(coalesce(num_words, 0) AS INT) AS num_words,
      coalesce(parse_tree_depth, 0) AS parse_tree_depth, coalesce(types / nullif(alphas, 0), 0) AS type_token_ratio,
      coalesce(passive / nullif(verbal, 0), 0) AS passive_ratio,
      CAST({hedges} AS INT) AS hedge_count, coalesce(({hedges}) / nullif(num_words, 0), 0) AS hedge_rate,
      CAST({discourse} AS INT) AS discourse_count, coalesce(({discourse}) / nullif(num_words, 0), 0) AS discourse_rate,
      coalesce(letters / nullif(num_words, 0), 0) AS avg_word_length, coalesce(n_punct / n_tok, 0) AS punct_ratio,
      coalesce(nn / nullif(num_words, 0), 0) AS pct_noun, coalesce(vb / nullif(num_words, 0), 0) AS pct_verb,
      coalesce(jj / nullif(num_words, 0), 0) AS pct_adj, coalesce(rb / nullif(num_words, 0), 0) AS pct_adv,
      coalesce(pr / nullif(num_words, 0), 0) AS pct_pron
    FROM src LEFT JOIN wd USING (message_id) LEFT JOIN sd USING (message_id))"""
