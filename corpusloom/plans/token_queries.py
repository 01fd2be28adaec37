"""Queries over annotated tokens: tagging, patterns, token features, style features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.functions import vocab
from corpusloom.functions.arrays import explode_rows
from corpusloom.functions.numeric import half_even
from corpusloom.lookups import literal_map
from corpusloom.operators import annotate as an
from corpusloom.operators import clustering, counting, depth, gazetteer, ordering, sequence, tagging, words
from corpusloom.operators import features as ft
from corpusloom.operators import sentences as sentence_breaks
from corpusloom.plans import flows
from corpusloom.plans.corpus_queries import TEST_DISCOURSE, TEST_HEDGES, _phrases_sql, texts
from corpusloom.plans.registry import RESPONSES_SQL, messages, query, responses, spread, table
from corpusloom.plans.token_sql import annotated_sql, listed, style_sql, tagged_sql
from corpusloom.session import materialise

# Words of the given tables that stand in for the default lists, which do not occur in them.
TEST_SPANS = tagging.SpanVocabulary(actions=["be", "ing", "ed"], places=["tion", "ther", "thing"])
TEST_FEATURES = ft.FeatureVocabulary(actions=["be", "ing", "ed"], places=["tion", "ther", "thing"])

_DOCS = "SELECT doc_id AS message_id, text AS raw_text FROM documents"
_ANN = "WITH RECURSIVE " + annotated_sql(_DOCS)
_BIO = _ANN + ", " + tagged_sql(TEST_SPANS)
_REPLIES = f"SELECT response_id AS message_id, response_text AS raw_text, source_type FROM ({RESPONSES_SQL})"
_HEDGES = _phrases_sql(TEST_HEDGES).replace("text", "raw_text")
_DISCOURSE = _phrases_sql(TEST_DISCOURSE).replace("text", "raw_text")
_STYLE = "WITH RECURSIVE " + annotated_sql(_REPLIES) + ", " + style_sql(_HEDGES, _DISCOURSE)
_STYLE_ROUNDED = ", ".join(
    c if c in ("num_sentences", "num_words", "hedge_count", "discourse_count") else f"round({c}, 9) AS {c}"
    for c in ft.STYLE_FEATURES
)


def tagged(spark: SparkSession, folder: str, fields: list[str]) -> DataFrame:
    """Every document annotated and tagged, whole texts, with the token fields that are read."""
    return tagging.tag_corpus(spread(messages(spark, folder)), TEST_SPANS, fields=fields)


def styled(spark: SparkSession, folder: str) -> DataFrame:
    """Style features of every reply."""
    return flows.style_rows(spread(responses(spark, folder)), TEST_HEDGES, TEST_DISCOURSE)


@query(r"""
  SELECT message_id, CAST(i - 1 AS INT) AS token_idx, token FROM (
    SELECT doc_id AS message_id, unnest(x) AS token, generate_subscripts(x, 1) AS i FROM (
      SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]') AS x FROM documents))""")
def tokens(spark: SparkSession, folder: str) -> DataFrame:
    return an.tokenize(messages(spark, folder))


@query(r"""
  SELECT message_id, CAST(row_number() OVER (PARTITION BY message_id ORDER BY i) - 1 AS INT) AS sent_idx, sentence FROM (
    SELECT doc_id AS message_id, unnest(x) AS sentence, generate_subscripts(x, 1) AS i FROM (
      SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS x FROM documents))
  WHERE regexp_replace(sentence, '\s+', '', 'g') <> ''""")
def sentences(spark: SparkSession, folder: str) -> DataFrame:
    return an.split_sentences(messages(spark, folder))


@query(_ANN + " SELECT message_id, token_idx, sent_idx, token, pos, tag_, dep, lemma, head_idx, ent_pos, is_ent FROM ann")
def annotated_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return an.explode_tokens(an.annotate_long(spread(messages(spark, folder))))


@query(_ANN + """
  SELECT message_id, token_idx - ent_pos AS start_idx, count(*) AS n, string_agg(token, ' ' ORDER BY token_idx) AS entity
  FROM ann WHERE is_ent = 1 GROUP BY message_id, token_idx - ent_pos""")
def entity_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Entities by the place where they start; the offset inside the span orders their tokens."""
    flat = an.annotate_long(spread(messages(spark, folder)))
    found = an.explode_tokens(flat.withColumn("tokens", F.filter("tokens", lambda tok: tok["is_ent"] == 1)))
    parts = F.array_sort(F.collect_list(F.struct("ent_pos", "token")))
    return found.groupBy("message_id", (F.col("token_idx") - F.col("ent_pos")).alias("start_idx")).agg(
        F.count("*").alias("n"), F.array_join(F.transform(parts, lambda x: x["token"]), " ").alias("entity")
    )


@query(_BIO + " SELECT message_id, token_idx, token, bio_tag FROM bio")
def bio_tags(spark: SparkSession, folder: str) -> DataFrame:
    return tagging.bio_tokens(tagged(spark, folder, ["token_idx", "token"]))


@query(_BIO + " SELECT bio_tag, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM bio GROUP BY bio_tag")
def tag_distribution(spark: SparkSession, folder: str) -> DataFrame:
    shares = counting.class_distribution(tagging.bio_tokens(tagged(spark, folder, [])), "bio_tag")
    return shares.withColumn("percent", F.round("percent", 6))


@query(_BIO + """,
  long AS (SELECT bio_tag, 'pos' AS attribute, pos AS value, 5 AS k FROM bio UNION ALL SELECT bio_tag, 'dep', dep, 5 FROM bio
           UNION ALL SELECT bio_tag, 'lemma', lemma, 10 FROM bio)
  SELECT bio_tag, attribute, value, n, CAST(r AS INT) AS rank FROM (
    SELECT bio_tag, attribute, value, k, count(*) AS n, row_number() OVER (PARTITION BY bio_tag, attribute ORDER BY count(*) DESC, value) AS r
    FROM long WHERE bio_tag IN ('B-LOC', 'B-ACT') GROUP BY bio_tag, attribute, value, k) WHERE r <= k""")
def span_patterns(spark: SparkSession, folder: str) -> DataFrame:
    return counting.span_patterns(tagging.bio_tokens(tagged(spark, folder, ["pos", "dep", "lemma"])))


@query(_BIO + """
  SELECT m.message_id, coalesce(string_agg(token, ' ' ORDER BY token_idx) FILTER (ends_with(bio_tag, 'LOC')), '') AS loc_tokens,
         coalesce(string_agg(token, ' ' ORDER BY token_idx) FILTER (ends_with(bio_tag, 'ACT')), '') AS act_tokens
  FROM src m LEFT JOIN bio USING (message_id) GROUP BY m.message_id""")
def token_lists(spark: SparkSession, folder: str) -> DataFrame:
    lists = tagging.token_lists(tagged(spark, folder, ["token"]))
    return lists.select(
        "message_id", F.array_join("loc_tokens", " ").alias("loc_tokens"), F.array_join("act_tokens", " ").alias("act_tokens")
    )


@query(_BIO + """
  SELECT CASE WHEN ends_with(bio_tag, 'LOC') THEN 'loc' WHEN ends_with(bio_tag, 'ACT') THEN 'act' ELSE 'other' END AS css, count(*) AS n
  FROM bio GROUP BY 1""")
def display_classes(spark: SparkSession, folder: str) -> DataFrame:
    css = F.coalesce(literal_map(vocab.DISPLAY_CLASSES)[F.col("bio_tag")], F.lit("other"))
    rows = tagging.bio_tokens(tagged(spark, folder, [])).select(css.alias("css"))
    return rows.groupBy("css").agg(F.count("*").alias("n"))


_ENCODERS = _BIO + f""",
  vocabulary AS (SELECT 'pos' AS kind, pos AS value FROM bio UNION SELECT 'dep', dep FROM bio UNION SELECT 'bio', bio_tag FROM bio
            UNION SELECT 'pos', unnest([{listed(vocab.SEED_POS)}])),
  enc AS (SELECT kind, value, CAST(row_number() OVER (PARTITION BY kind ORDER BY value) - 1 AS INT) AS code FROM vocabulary)"""


@query(_ENCODERS + " SELECT kind, value, code FROM enc")
def encoder_tables(spark: SparkSession, folder: str) -> DataFrame:
    return ft.fit_encoders(tagging.bio_tokens(tagged(spark, folder, ["pos", "dep"])))


FEATURES_SQL = _ENCODERS + rf""",
  f AS (SELECT message_id, token_idx, token, pos, dep, lemma, is_ent, ent_type, bio_tag, coalesce(lag(pos) OVER m, 'X') AS prev_pos,
      coalesce(lead(pos) OVER m, 'X') AS next_pos, coalesce(lag(lemma) OVER m, '') AS prev_lemma, count(*) OVER (PARTITION BY message_id) AS n
      FROM bio WINDOW m AS (PARTITION BY message_id ORDER BY token_idx)),
  feats AS (SELECT message_id, token_idx, token, pos, dep, ent_type, p.code AS pos_enc, d.code AS dep_enc,
    coalesce(pp.code, 0) AS prev_pos_enc, coalesce(np.code, 0) AS next_pos_enc,
    CAST(prev_lemma IN ({listed(TEST_FEATURES.prepositions)}) AS INT) AS prev_is_prep, CAST(next_pos IN ('NOUN', 'PROPN') AS INT) AS next_is_noun,
    CAST(lemma IN ({listed(TEST_FEATURES.actions)}) AS INT) AS is_act_verb, CAST(lemma IN ({listed(TEST_FEATURES.places)}) AS INT) AS is_loc_word,
    CAST(regexp_matches(token, '^\p{{Lu}}') AS INT) AS is_capitalized, is_ent,
    round_even(token_idx / greatest(n - 1, 1), 4) AS token_pos_norm, round_even(n / 50.0, 4) AS sentence_len,
    CAST(regexp_matches(replace(replace(token, '.', ''), ',', ''), '^\p{{Nd}}+$') AS INT) AS is_number, b.code AS bio_enc
  FROM f JOIN enc p ON p.kind = 'pos' AND p.value = f.pos JOIN enc d ON d.kind = 'dep' AND d.value = f.dep
    LEFT JOIN enc pp ON pp.kind = 'pos' AND pp.value = f.prev_pos LEFT JOIN enc np ON np.kind = 'pos' AND np.value = f.next_pos
    JOIN enc b ON b.kind = 'bio' AND b.value = f.bio_tag)"""


@query(FEATURES_SQL + f" SELECT message_id, token_idx, {', '.join(ft.TOKEN_FEATURES)}, bio_enc FROM feats")
def token_features(spark: SparkSession, folder: str) -> DataFrame:
    """Token rows are written once; the encoders and the features both read them."""
    rows = materialise(ft.token_columns(tagged(spark, folder, ft.TOKEN_FIELDS), TEST_FEATURES), "token-columns")
    return ft.encode_tokens(rows, ft.encoder_maps(ft.fit_encoders(rows)))


@query(r"""
  WITH x AS (SELECT doc_id AS message_id, unnest(x) AS token, generate_subscripts(x, 1) - 1 AS token_idx FROM (
      SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]') AS x FROM documents))
  SELECT message_id, CAST(token_idx AS INT) AS token_idx, token, coalesce(lag(token) OVER w, '') AS prev_token,
         coalesce(lead(token) OVER w, '') AS next_token,
         round_even(token_idx / greatest(count(*) OVER (PARTITION BY message_id) - 1, 1), 4) AS token_pos_norm
  FROM x WINDOW w AS (PARTITION BY message_id ORDER BY token_idx)""")
def token_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Neighbours and relative position in a token table, one row per token; token rows are shuffled once, by message and range."""
    width = 1024
    rows = an.tokenize(spread(messages(spark, folder)))
    found = {"prev_token": ("token", -1, ""), "next_token": ("token", 1, "")}
    beside = ordering.neighbours(rows, "token_idx", ["message_id"], found, width, range_name="range")
    sizes = rows.groupBy("message_id").agg(F.count("*").alias("n"), F.max("token_idx").alias("last"))
    ranges = F.sequence(F.lit(0), F.col("last"), F.lit(width)).alias("range")
    place = half_even(F.col("token_idx") / F.greatest(F.col("n") - 1, F.lit(1)), 4)
    return ordering.salted_join(beside, sizes.select("message_id", "n", ranges), ["message_id"], salt="range").select(
        "message_id", "token_idx", "token", "prev_token", "next_token", place.alias("token_pos_norm")
    )


@query(r"""
  WITH x AS (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]|\s+')) AS token FROM documents)
  SELECT CAST(regexp_matches(token, '^\p{Lu}') AS INT) AS capitalised,
         CAST(regexp_matches(replace(replace(token, '.', ''), ',', ''), '^\p{Nd}+$') AS INT) AS numeric,
         CAST(regexp_matches(token, '^\p{L}+$') AS INT) AS alphabetic, CAST(regexp_matches(token, '^\p{P}+$') AS INT) AS punctuation,
         CAST(regexp_matches(token, '^\s+$') AS INT) AS space, CAST(length(token) AS INT) AS length, count(*) AS n
  FROM x GROUP BY ALL""")
def token_shapes(spark: SparkSession, folder: str) -> DataFrame:
    found = F.regexp_extract_all(F.col("text"), F.lit(f"{an.TOKEN_PATTERN}|{t.SPACE}+"), F.lit(0))
    token = F.col("token")
    shapes = explode_rows(texts(spark, folder), [], found, "token").select(
        t.is_capitalised(token).cast("int").alias("capitalised"), t.is_numeric(token).cast("int").alias("numeric"),
        t.is_alphabetic(token).cast("int").alias("alphabetic"), t.is_punctuation(token).cast("int").alias("punctuation"),
        t.is_space(token).cast("int").alias("space"), F.length(token).alias("length"),
    )
    return shapes.groupBy(*shapes.columns).agg(F.count("*").alias("n"))


@query(r"""
  WITH v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM benchmark),
  x AS (SELECT doc_id AS message_id, lower(unnest(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]'))) AS token FROM documents)
  SELECT message_id, count(*) AS hits FROM x SEMI JOIN v ON v.word = x.token GROUP BY message_id""")
def vocabulary_hits(spark: SparkSession, folder: str) -> DataFrame:
    """The words of the benchmark as a user's vocabulary."""
    vocabulary = words.letter_word_counts(table(spark, folder, "benchmark"), "text")
    rows = an.tokenize(spread(messages(spark, folder))).withColumn("token", F.lower("token"))
    hits = words.vocabulary_hits(rows, vocabulary, "token")
    return hits.groupBy("message_id").agg(F.count("*").alias("hits"))


# ---- style -------------------------------------------------------------------------------------

@query(_STYLE + f" SELECT message_id AS response_id, source_type, {_STYLE_ROUNDED} FROM style")
def style_features(spark: SparkSession, folder: str) -> DataFrame:
    styles = styled(spark, folder).select("response_id", "source_type", *ft.STYLE_FEATURES)
    doubles = [f.name for f in styles.schema if f.dataType.simpleString() == "double"]
    return styles.withColumns({c: F.round(c, 9) for c in doubles})


_MEANS = ", ".join(f"round(avg({c}), 5) AS {c}" for c in ft.STYLE_FEATURES)


@query(_STYLE + f" SELECT source_type, {_MEANS} FROM style GROUP BY source_type")
def style_means(spark: SparkSession, folder: str) -> DataFrame:
    means = styled(spark, folder).groupBy("source_type").agg(*[F.round(F.avg(c), 5).alias(c) for c in ft.STYLE_FEATURES])
    return means


@query(_STYLE + f""",
  means AS (SELECT source_type, {_MEANS} FROM style GROUP BY source_type),
  long AS (UNPIVOT means ON {", ".join(ft.STYLE_FEATURES)} INTO NAME feature VALUE v)
  SELECT feature, max(v) FILTER (source_type = 'human') AS human, max(v) FILTER (source_type = 'AI') AS "AI" FROM long GROUP BY feature""")
def style_means_transposed(spark: SparkSession, folder: str) -> DataFrame:
    means = counting.group_means(styled(spark, folder), "source_type", ft.STYLE_FEATURES, digits=5)
    return counting.transposed(means, "source_type", ft.STYLE_FEATURES, ["human", "AI"])


@query(_STYLE + f""", labels_ AS (SELECT response_id, CAST(source_type = 'AI' AS INT) AS label FROM ({RESPONSES_SQL}))
  SELECT response_id, num_words, num_sentences, label FROM style JOIN labels_ ON response_id = message_id""")
def features_with_labels(spark: SparkSession, folder: str) -> DataFrame:
    features = styled(spark, folder).select("response_id", "num_words", "num_sentences")
    labels = responses(spark, folder).select("response_id", (F.col("source_type") == "AI").cast("int").alias("label"))
    return ft.join_labels(features, labels, ["response_id"])


_SCALED = ", ".join(
    f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () > 0 THEN stddev_pop({c}) OVER () ELSE 1 END, 6) AS {c}"
    for c in ft.STYLE_FEATURES
)


@query(_STYLE + f" SELECT message_id AS response_id, {_SCALED} FROM style")
def standardised_features(spark: SparkSession, folder: str) -> DataFrame:
    scaled = clustering.standardise(styled(spark, folder), ft.STYLE_FEATURES)
    return scaled.select("response_id", *[F.round(c, 6).alias(c) for c in ft.STYLE_FEATURES])


# ---- listed entities and long trees ------------------------------------------------------------

@query(r"""
  WITH RECURSIVE bw AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]') AS w FROM benchmark),
  en AS MATERIALIZED (SELECT phrase, min(kind) AS kind, len(string_split(phrase, ' ')) AS n FROM (
      SELECT array_to_string(w[1:2], ' ') AS phrase, 'opening' AS kind FROM bw UNION ALL SELECT array_to_string(w[1:4], ' '), 'opening' FROM bw
      UNION ALL SELECT array_to_string(w[3:5], ' '), 'middle' FROM bw) WHERE phrase <> '' GROUP BY phrase),
  tk AS MATERIALIZED (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]') AS w FROM documents WHERE text IS NOT NULL),
  ng AS (SELECT doc_id, i, n, lower(array_to_string(w[i:i + n - 1], ' ')) AS phrase FROM (
      SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM tk, (SELECT DISTINCT n FROM en))),
  hit AS MATERIALIZED (SELECT doc_id, i, max(n) AS n FROM ng SEMI JOIN en USING (phrase, n) GROUP BY doc_id, i),
  nx AS MATERIALIZED (SELECT a.doc_id, a.i, a.n, b.i AS following FROM hit a ASOF LEFT JOIN hit b ON a.doc_id = b.doc_id AND a.i + a.n <= b.i),
  walk AS (SELECT doc_id, min(i) AS i FROM nx GROUP BY doc_id
    UNION ALL SELECT nx.doc_id, nx.following FROM walk JOIN nx ON nx.doc_id = walk.doc_id AND nx.i = walk.i WHERE nx.following IS NOT NULL)
  SELECT doc_id AS message_id, CAST(i - 1 AS INT) AS start_idx, CAST(n AS INT) AS n_tokens, array_to_string(w[i:i + n - 1], ' ') AS entity, kind
  FROM walk JOIN nx USING (doc_id, i) JOIN tk USING (doc_id) JOIN en ON en.phrase = lower(array_to_string(w[i:i + nx.n - 1], ' '))""".replace(
    "w[i:i + n - 1], ' ') AS entity", "w[i:i + nx.n - 1], ' ') AS entity").replace("CAST(n AS INT) AS n_tokens", "CAST(nx.n AS INT) AS n_tokens"))
def listed_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Openings and middles of benchmark passages found in the documents."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(an.TOKEN_PATTERN), F.lit(0))
    passages = table(spark, folder, "benchmark").select(words.alias("w"))
    cuts = F.array(*[F.struct(F.array_join(F.slice("w", a, n), " ").alias("phrase"), F.lit(kind).alias("kind")) for a, n, kind in (
        (1, 2, "opening"), (1, 4, "opening"), (3, 3, "middle"))])
    entries = materialise(gazetteer.gazetteer_entries(passages.select(F.inline(cuts))), "entries")
    tokens = F.regexp_extract_all(F.col("raw_text"), F.lit(an.TOKEN_PATTERN), F.lit(0))
    return gazetteer.entity_spans(messages(spark, folder).select("message_id", tokens.alias("tokens")), entries)


@query(_ANN + """,
  first AS (SELECT message_id, sent_idx, min(token_idx) AS root FROM ann WHERE head_idx = token_idx GROUP BY ALL),
  down AS (SELECT message_id, sent_idx, root AS node, 1 AS depth FROM first
    UNION ALL SELECT a.message_id, a.sent_idx, a.token_idx, depth + 1 FROM down d JOIN ann a
      ON a.message_id = d.message_id AND a.sent_idx = d.sent_idx AND a.head_idx = d.node AND a.token_idx <> d.node)
  SELECT message_id, sent_idx, CAST(max(depth) AS BIGINT) AS depth FROM down GROUP BY message_id, sent_idx""")
def token_tree_depths(spark: SparkSession, folder: str) -> DataFrame:
    """Depth of the tree of every sentence, from the long token table alone."""
    flat = an.annotate_long(spread(messages(spark, folder)), fields=["token_idx", "sent_idx", "head_idx"])
    return depth.tree_depths(an.explode_tokens(flat), ["message_id", "sent_idx"])


# ---- learnt sentence breaks --------------------------------------------------------------------

_SCORES = r"""
  wd AS (SELECT rtrim(w, '.') AS word, ends_with(w, '.') AS stop FROM (
      SELECT unnest(regexp_extract_all(lower(text), '\p{L}+(?:\.\p{L}+)*\.?')) AS w FROM documents)),
  ct AS MATERIALIZED (SELECT word, count(*) AS n, count_if(stop) AS n_stop FROM wd GROUP BY word),
  pr AS (SELECT least(sum(n_stop) / sum(n), 1 - 1e-9) AS p FROM ct),
  sc AS MATERIALIZED (SELECT word, n, n_stop, 2 * (n_stop * ln(0.99) + (n - n_stop) * ln(1 - 0.99) - (n_stop * ln(p) + (n - n_stop) * ln(1 - p)))
      * exp(-length(replace(word, '.', ''))) * (1 + length(word) - length(replace(word, '.', ''))) * pow(length(replace(word, '.', ''))::DOUBLE, n_stop - n) AS score
    FROM ct, pr WHERE n_stop > 0)"""


@query("WITH " + _SCORES + " SELECT word, n, n_stop, round(score, 6) AS score FROM sc WHERE score >= 0.3")
def abbreviations(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the documents that the stops behind them show to be abbreviations."""
    scores = sentence_breaks.abbreviation_scores(messages(spark, folder))
    known = sentence_breaks.abbreviations(scores)
    return scores.join(known, "word").withColumn("score", F.round("score", 6))


@query("WITH " + _SCORES + r""",
  pa AS (SELECT doc_id, p, unnest(x) AS part, generate_subscripts(x, 1) AS i FROM (
      SELECT doc_id, string_split(regexp_replace(text, '([.!?])(\s)', '\1' || chr(1) || '\2', 'g'), chr(1)) AS x, 0 AS p FROM documents WHERE text IS NOT NULL)),
  mk AS (SELECT doc_id, i, part, coalesce(score >= 0.3, false) AND last_ <> '' AS joins FROM (
      SELECT *, lower(regexp_extract(part, '(?:^|[^\p{L}.])(\p{L}+(?:\.\p{L}+)*)\.$', 1)) AS last_ FROM pa) LEFT JOIN sc ON sc.word = last_),
  gp AS (SELECT *, coalesce(sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM mk),
  st AS (SELECT doc_id, g, regexp_replace(string_agg(part, '' ORDER BY i), '^\s+', '') AS sentence FROM gp GROUP BY doc_id, g)
  SELECT doc_id AS message_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY g) - 1 AS INT) AS sent_idx, sentence
  FROM st WHERE regexp_replace(sentence, '\s+', '', 'g') <> ''""")
def learnt_sentences(spark: SparkSession, folder: str) -> DataFrame:
    """Sentences of the documents, with the abbreviations learnt from all of them."""
    known = sentence_breaks.abbreviations(sentence_breaks.abbreviation_scores(messages(spark, folder)))
    return sentence_breaks.learnt_sentences(messages(spark, folder), known)


# ---- a learnt tagger ---------------------------------------------------------------------------

_CLASS = r"CASE WHEN regexp_matches(word, '\p{Nd}') THEN '#' WHEN NOT regexp_matches(word, '\p{L}') THEN '.' ELSE '-' || right(word, 2) END"
_LN = "CAST(round(ln(({n} + 1) / ({total} + {kinds})) * 1000000) AS BIGINT)"


@query(_ANN + f""",
  lab AS MATERIALIZED (SELECT message_id, sent_idx, token_idx, lower(token) AS word, pos AS tag, md5('tagger|' || message_id) < '8' AS train,
      coalesce(lag(pos) OVER s, '') AS before, row_number() OVER s AS i FROM ann WINDOW s AS (PARTITION BY message_id, sent_idx ORDER BY token_idx)),
  tg AS MATERIALIZED (SELECT tag, n::DOUBLE AS n, row_number() OVER (ORDER BY tag) AS t, count(*) OVER () AS k
      FROM (SELECT tag, count(*) AS n FROM lab WHERE train GROUP BY tag)),
  tm AS MATERIALIZED (SELECT list(l ORDER BY t) AS m FROM (SELECT t, list(s ORDER BY b) AS l FROM (
      SELECT t.t, b.b, {_LN.format(n="coalesce(c.n, 0)", total="sum(coalesce(c.n, 0)) OVER (PARTITION BY b.b)", kinds="t.k")} AS s
      FROM tg t CROSS JOIN (SELECT tag, t AS b FROM tg UNION ALL SELECT '', (SELECT count(*) + 1 FROM tg)) b
        LEFT JOIN (SELECT before, tag, count(*)::DOUBLE AS n FROM lab WHERE train GROUP BY ALL) c ON c.before = b.tag AND c.tag = t.tag) GROUP BY t)),
  wt AS (SELECT word, tag, count(*)::DOUBLE AS n FROM lab WHERE train GROUP BY ALL),
  kw AS (SELECT word FROM wt GROUP BY word HAVING sum(n) >= 2),
  ct AS (SELECT {_CLASS} AS class, tag, sum(n) AS n FROM wt GROUP BY ALL),
  we AS (SELECT word, list(s ORDER BY t) AS e FROM (SELECT kw.word, t.t, {_LN.format(n="coalesce(wt.n, 0)", total="t.n", kinds="(SELECT count(*) FROM kw)")} AS s
      FROM kw CROSS JOIN tg t LEFT JOIN wt ON wt.word = kw.word AND wt.tag = t.tag) GROUP BY word),
  ce AS (SELECT class, list(s ORDER BY t) AS e FROM (SELECT c.class, t.t, {_LN.format(n="coalesce(ct.n, 0)", total="t.n", kinds="(SELECT count(DISTINCT class) FROM ct)")} AS s
      FROM (SELECT DISTINCT class FROM ct) c CROSS JOIN tg t LEFT JOIN ct ON ct.class = c.class AND ct.tag = t.tag) GROUP BY class),
  ue AS (SELECT list(s ORDER BY t) AS e FROM (SELECT t, {_LN.format(n="0", total="n", kinds="(SELECT count(DISTINCT class) FROM ct)")} AS s FROM tg)),
  held AS MATERIALIZED (SELECT message_id, sent_idx, i, tag, coalesce(we.e, ce.e, (SELECT e FROM ue)) AS e FROM (SELECT *, {_CLASS} AS class FROM lab WHERE NOT train) l
      LEFT JOIN we USING (word) LEFT JOIN ce USING (class)),
  sz AS (SELECT m, len(m) AS k FROM tm),
  fwd AS (SELECT message_id, sent_idx, i, [m[t][k + 1] + e[t] FOR t IN range(1, k + 1)] AS s, NULL::BIGINT[] AS bp FROM held, sz WHERE i = 1
    UNION ALL
    SELECT message_id, sent_idx, i, [list_max(through[t]) + e[t] FOR t IN range(1, len(e) + 1)], [list_position(x, list_max(x))::BIGINT FOR x IN through]
    FROM (SELECT h.*, [[r.s[b] + m[t][b] FOR b IN range(1, k + 1)] FOR t IN range(1, k + 1)] AS through
          FROM fwd r JOIN held h ON h.message_id = r.message_id AND h.sent_idx = r.sent_idx AND h.i = r.i + 1, sz)),
  bwd AS (SELECT message_id, sent_idx, i, list_position(s, list_max(s))::BIGINT AS t, bp FROM fwd
      QUALIFY i = max(i) OVER (PARTITION BY message_id, sent_idx)
    UNION ALL
    SELECT f.message_id, f.sent_idx, f.i, b.bp[b.t], f.bp FROM bwd b JOIN fwd f ON f.message_id = b.message_id AND f.sent_idx = b.sent_idx AND f.i = b.i - 1)
  SELECT h.tag AS expected, tg.tag AS predicted, count(*) AS n FROM bwd b JOIN held h USING (message_id, sent_idx, i) JOIN tg ON tg.t = b.t GROUP BY ALL""")
def tagger_confusion(spark: SparkSession, folder: str) -> DataFrame:
    """Parts of speech of half of the documents by a tagger learnt from the other half, against the lexicon's."""
    annotated = an.annotate(spread(messages(spark, folder)), fields=["token", "pos"]).select("message_id", "sentences")
    annotated = materialise(annotated.withColumn("train", F.md5(F.concat(F.lit("tagger|"), "message_id")) < "8"), "annotated")
    tagger = sequence.fit_tagger(sequence.labelled_words(annotated.where("train")))
    tagged = sequence.tag_sentences(annotated.where("NOT train"), tagger)
    expected = F.transform("sentences", lambda s: F.transform(s, lambda tok: tok["pos"]))
    pairs = F.transform(F.arrays_zip(F.flatten(expected).alias("x"), F.flatten("tags").alias("y")), lambda p: F.struct(
        p["x"].alias("expected"), p["y"].alias("predicted")))
    rows = explode_rows(tagged, [], pairs, "p").select("p.*")
    return rows.groupBy("expected", "predicted").agg(F.count("*").alias("n"))
