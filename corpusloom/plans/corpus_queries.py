"""Queries over whole texts: corpus building, counting, splitting, chat, words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions import text as t
from corpusloom.functions import vocab
from corpusloom.functions.numeric import argmax, half_even, ratio, softmax
from corpusloom.functions.stemming import add_stems
from corpusloom.lookups import gathered
from corpusloom.operators import chat, corpus, counting, ordering, split, words
from corpusloom.operators import tickets as tk
from corpusloom.plans.porter_sql import PORTER_SQL
from corpusloom.plans.registry import (
    RESPONSES_SQL,
    TICKETS_SQL,
    query,
    responses,
    spread,
    strip_sql,
    table,
    tickets,
)
from corpusloom.session import scratch_path
from corpusloom.sources import tables
from corpusloom.sources.template_data import (
    AI_FILLERS,
    AI_TEMPLATES,
    HUMAN_FILLERS,
    HUMAN_TEMPLATES,
    filler_table,
    template_table,
)

CATEGORIES = ["advice", "factual", "creative", "opinion"]
PRIORITIES = list(vocab.PRIORITY_CODES)
# Words of the given tables that stand in for the default lists, which do not occur in them.
STOP_COMMANDS = ["the", "this", "an"]
TEST_HEDGES = ["that", "with"]
TEST_DISCOURSE = ["for", "as"]
LEAST_KEY = min([n for _, n in vocab.KEY_SHAPES] + [len(x) for x in vocab.KEY_PLACEHOLDERS])
TOKEN_SHAPE = rf"[A-Za-z0-9_.\-]{{{LEAST_KEY},}}"


def quoted(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def prompts(spark: SparkSession, folder: str) -> DataFrame:
    category = F.get(F.array(*[F.lit(c) for c in CATEGORIES]), (F.col("item_id") % 4).cast("int"))
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("prompt_no"), F.col("item_id").alias("prompt_id"), category.alias("category"),
        F.col("text").alias("prompt"),
    )


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """documents for work that is heavy per text."""
    return spread(table(spark, folder, "documents").select("doc_id", "text"))


# ---- sources and sinks -------------------------------------------------------------------------

@query(f"SELECT response_id, prompt_id, response_text, source_type FROM ({RESPONSES_SQL})")
def csv_sink_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "responses-csv")
    tables.write_csv(responses(spark, folder), path)
    return tables.read_csv(
        spark, path, "response_id string, prompt_id bigint, response_text string, source_type string"
    )


@query("""
  WITH m AS (SELECT source, avg(CAST(n_chars > 600 AS INT)) AS accuracy, avg(CAST(lang = 'en' AS INT)) AS f1, avg(CAST(lang = 'de' AS INT)) AS precision,
                    avg(CAST(lang = 'fr' AS INT)) AS recall FROM documents GROUP BY source),
  e AS (SELECT 'classification' AS part, source AS name, unnest(['accuracy', 'precision', 'recall', 'f1']) AS field, unnest([accuracy, precision, recall, f1]) AS value FROM m
    UNION ALL (SELECT 'top_features', source, 'importance', f1 FROM m ORDER BY f1 DESC, source LIMIT 8)
    UNION ALL SELECT 'cluster_alignment', 'kmeans_ari', 'ari', max(f1) FROM m UNION ALL SELECT 'cluster_alignment', 'hierarchical_ari', 'ari', min(f1) FROM m)
  SELECT part, name, field, round(value, 6) AS value FROM e""")
def json_summary_sink_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Shares by source as one nested JSON row, written and read back, all parts of it."""
    share = lambda test: F.avg(test.cast("int"))
    scores = table(spark, folder, "documents").groupBy(F.col("source").alias("model")).agg(
        share(F.col("n_chars") > 600).alias("accuracy"), share(F.col("lang") == "de").alias("precision"),
        share(F.col("lang") == "fr").alias("recall"), share(F.col("lang") == "en").alias("f1"),
    )
    importances = scores.select(F.col("model").alias("feature"), F.col("f1").alias("importance"))
    alignment = scores.agg(F.max("f1").alias("kmeans_ari"), F.min("f1").alias("hierarchical_ari"))
    path = scratch_path(spark, "summary-json")
    tables.write_json(tables.summary_row(scores, importances, alignment), path)
    return tables.summary_entries(tables.read_json(spark, path, schemas.SUMMARY)).withColumn("value", F.round("value", 6))


@query(f"""
  WITH t AS ({TICKETS_SQL}),
  parts AS (
    SELECT doc_id, 0 AS ticket_no, '[' || coalesce({strip_sql('type')}, '') || '] ' || coalesce({strip_sql('subject')}, '')
           || ' | ' || coalesce({strip_sql('body')}, '') AS text FROM t
    UNION ALL SELECT doc_id, 1, {strip_sql('subject')} FROM t)
  SELECT doc_id, CAST(ticket_no AS INT) AS ticket_no, {strip_sql('text')} AS text FROM parts
  WHERE {strip_sql('text')} <> ''""")
def ticket_requests(spark: SparkSession, folder: str) -> DataFrame:
    """The tickets of nested requests that are not blank."""
    parsed = tk.parse_requests(ticket_bodies(spark, folder), ["doc_id"], F.col("body"))
    return tk.scoring_text(parsed).select("doc_id", "ticket_no", "text")


def ticket_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Nested JSON requests, one per document: a ticket in parts, one as text, and a blank one."""
    none = F.lit(None).cast("string")
    fields = lambda *values: F.struct(*[v.alias(n) for n, v in zip(("type", "subject", "body", "text"), values)])
    batch = F.array(
        fields(F.col("type"), F.col("subject"), F.col("body"), none),
        fields(none, none, none, F.col("subject")),
        fields(F.lit(" "), F.lit("\n"), none, F.lit("  ")),
    )
    return tickets(spark, folder).select("doc_id", F.to_json(F.struct(batch.alias("tickets"))).alias("body"))


def _templates_sql(templates: dict[str, list[str]], fillers: dict[str, list[tuple[str, str]]], source: str, prefix: str) -> str:
    rows = [f"('{c}', {i}, {quoted([x])})" for c, xs in templates.items() for i, x in enumerate(xs)]
    pairs = [f"('{c}', {i}, {quoted([a])}, {quoted([b])})" for c, xs in fillers.items() for i, (a, b) in enumerate(xs)]
    return f"""
  SELECT '{prefix}_' || printf('%04d', (p.k * 4 + r.i + 1)::BIGINT) AS response_id, p.item_id AS prompt_id, p.text AS prompt,
         list_reduce([replace(part, '{{b}}', f.b) FOR part IN string_split(t.x, '{{a}}')], lambda x, y: x || f.a || y) AS response_text, '{source}' AS source_type
  FROM (SELECT *, row_number() OVER (ORDER BY item_id) - 1 AS k, (['advice','factual','creative','opinion'])[item_id % 4 + 1] AS cat FROM benchmark) p
  CROSS JOIN (SELECT unnest(range(0, 4)) AS i) r
  JOIN (VALUES {", ".join(rows)}) t(cat, i, x) ON t.cat = p.cat AND t.i = r.i
  JOIN (VALUES {", ".join(pairs)}) f(cat, i, a, b) ON f.cat = p.cat AND f.i = r.i"""


@query(
    _templates_sql(HUMAN_TEMPLATES, HUMAN_FILLERS, "human", "H")
    + " UNION ALL "
    + _templates_sql(AI_TEMPLATES, AI_FILLERS, "AI", "AI")
)
def template_corpus(spark: SparkSession, folder: str) -> DataFrame:
    asked = prompts(spark, folder)
    sides = [
        corpus.expand_templates(asked, template_table(spark, ts), filler_table(spark, fs), source, prefix)
        for ts, fs, source, prefix in (
            (HUMAN_TEMPLATES, HUMAN_FILLERS, "human", "H"), (AI_TEMPLATES, AI_FILLERS, "AI", "AI")
        )
    ]
    return sides[0].unionByName(sides[1])


@query(f"""
  WITH r AS (
    SELECT *, row_number() OVER (ORDER BY item_id) - 1 AS k FROM benchmark),
  x AS (SELECT 'AI_' || printf('%04d', (k * 5 + i + 1)::BIGINT) AS response_id, item_id AS prompt_id, text AS prompt,
               coalesce({strip_sql("split_part(text, '. ', (i + 1)::INT)")}, '') AS response_text
        FROM r CROSS JOIN (SELECT unnest(range(0, 5)) AS i))
  SELECT response_id, prompt_id, prompt, response_text, 'AI' AS source_type FROM x WHERE length(response_text) > 20""")
def prompt_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """Five requests per prompt; the i-th sentence of the prompt stands for the answer."""
    answer = F.split_part("prompt", F.lit(". "), F.col("replica") + 1)
    return corpus.fan_out(prompts(spark, folder), answer)


# ---- projections, filters, predicates ----------------------------------------------------------

@query(f"""
  SELECT 'KG_' || printf('%05d', doc_id) AS message_id, text AS raw_text, 'documents_en' AS source
  FROM documents WHERE lang = 'en' AND length({strip_sql('text')}) > 10""")
def filter_messages(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), "text", (F.col("lang") == "en").cast("int").alias("target")
    )
    kept = corpus.filter_messages(raw, "documents_en")
    return kept.where(t.long_enough(F.col("raw_text"), 10))


_UNION_SQL = """
  SELECT 0 AS source_rank, 'KG_' || printf('%05d', doc_id) AS message_id, text AS raw_text, 'documents' AS source FROM documents
  UNION ALL SELECT 1, 'HI_' || printf('%04d', item_id), text, 'benchmark' FROM benchmark
  UNION ALL SELECT 2, conv_id || '_' || turn, text, 'conversations' FROM conversations"""


def _union(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    items = table(spark, folder, "benchmark").select(
        t.prefixed_id(F.col("item_id"), "HI", 4).alias("message_id"), F.col("text").alias("raw_text"),
        F.lit("benchmark").alias("source"),
    )
    turns = table(spark, folder, "conversations").select(
        F.concat_ws("_", "conv_id", "turn").alias("message_id"), F.col("text").alias("raw_text"),
        F.lit("conversations").alias("source"),
    )
    return corpus.union_sources(corpus.filter_messages(docs, "documents"), items, turns)


@query(f"SELECT source, count(*) AS n, CAST(sum(length(raw_text)) AS BIGINT) AS chars FROM ({_UNION_SQL}) GROUP BY source")
def union_corpora(spark: SparkSession, folder: str) -> DataFrame:
    both = _union(spark, folder)
    return both.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.length("raw_text")).alias("chars"))


@query(f"""
  WITH u AS (SELECT source_rank, message_id, {strip_sql('raw_text')} AS raw_text, source FROM ({_UNION_SQL})),
  r AS (SELECT *, row_number() OVER (PARTITION BY raw_text ORDER BY source_rank, length(message_id), message_id) AS rn
        FROM u WHERE length(raw_text) > 10)
  SELECT message_id, raw_text, source FROM r WHERE rn = 1""")
def clean_corpus(spark: SparkSession, folder: str) -> DataFrame:
    ranked = _union(spark, folder).withColumn("id_length", F.length("message_id"))
    cleaned = corpus.clean_corpus(ranked, order=["source_rank", "id_length", "message_id"])
    return cleaned.select("message_id", "raw_text", "source")


@query("""
  SELECT doc_id, source, lang FROM (
    SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def keep_first(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    return corpus.keep_first(docs, "text", ["doc_id"]).select("doc_id", "source", "lang")


@query(f"""
  WITH d AS (SELECT source, {strip_sql('text')} AS raw_text, doc_id FROM documents WHERE lang = 'en'),
  r AS (SELECT *, row_number() OVER (PARTITION BY raw_text ORDER BY doc_id) AS rn FROM d WHERE length(raw_text) > 10)
  SELECT source, count(*) AS n FROM r WHERE rn = 1 GROUP BY source""")
def clean_counts_by_source(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").where(F.col("lang") == "en").select(
        F.col("doc_id").alias("message_id"), F.col("text").alias("raw_text"), "source"
    )
    return counting.value_counts(corpus.clean_corpus(docs), "source")


@query(f"""
  SELECT doc_id, text, CAST(label AS INT) AS label, priority FROM (
    SELECT doc_id, {strip_sql("'[' || coalesce(type, '') || '] ' || coalesce(subject, '') || ' | ' || coalesce(body, '')")} AS text,
           CASE priority WHEN 'low' THEN 0 WHEN 'medium' THEN 1 WHEN 'high' THEN 2 END AS label, priority
    FROM ({TICKETS_SQL}) WHERE language = 'en') WHERE label IS NOT NULL""")
def training_tickets(spark: SparkSession, folder: str) -> DataFrame:
    return tk.training_tickets(tickets(spark, folder)).select("doc_id", "text", "label", "priority")


@query(f"""
  WITH t AS (SELECT doc_id, {strip_sql("coalesce(type, '')")} AS type, {strip_sql("coalesce(subject, '')")} AS subject,
                    {strip_sql("coalesce(body, '')")} AS body FROM ({TICKETS_SQL}))
  SELECT doc_id, {strip_sql("'[' || type || '] ' || subject || ' | ' || body")} AS text FROM t
  WHERE type <> '' OR subject <> '' OR body <> ''""")
def scoring_tickets(spark: SparkSession, folder: str) -> DataFrame:
    raw = tickets(spark, folder).withColumn("text", F.lit(None).cast("string"))
    return tk.scoring_text(raw).select("doc_id", "text")


_VARIANT_SQL = """
  SELECT conv_id, turn, CASE role WHEN 'user' THEN ' Human ' WHEN 'assistant' THEN 'ai' ELSE 'said ' END AS raw_label
  FROM conversations"""


def _variants(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("role") == "user", " Human ").when(F.col("role") == "assistant", "ai").otherwise("said ")
    return table(spark, folder, "conversations").select("conv_id", "turn", label.alias("raw_label"))


@query(f"""
  SELECT conv_id, turn, replace(replace({strip_sql('raw_label')}, 'Human', 'human'), 'ai', 'AI') AS source_type
  FROM ({_VARIANT_SQL})""")
def normalised_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _variants(spark, folder).select("conv_id", "turn", t.normalised_label(F.col("raw_label")).alias("source_type"))


@query(f"""
  SELECT r.response_id, r.prompt_id::VARCHAR AS prompt_id, {strip_sql('r.response_text')} AS response_text,
         replace(replace({strip_sql('v.raw_label')}, 'Human', 'human'), 'ai', 'AI') AS source_type
  FROM ({RESPONSES_SQL}) r JOIN ({_VARIANT_SQL}) v ON r.response_id = v.conv_id || '_' || v.turn
  WHERE length({strip_sql('r.response_text')}) > 20""")
def loaded_responses(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("source_type") == "human", " Human ").otherwise("ai")
    raw = responses(spark, folder).withColumn("source_type", label).withColumn("prompt_id", F.col("prompt_id").cast("string"))
    return corpus.load_responses(raw.withColumn("prompt", F.lit(""))).drop("prompt")


@query(f"""
  SELECT count(*) AS rows, count(*) FILTER ({strip_sql('raw_label')} NOT IN ('human', 'AI', 'Human', 'ai')) AS odd_rows
  FROM ({_VARIANT_SQL})""")
def label_audit(spark: SparkSession, folder: str) -> DataFrame:
    labels = _variants(spark, folder).withColumn("raw_label", t.strip(F.col("raw_label")))
    return corpus.label_audit(labels, "raw_label", ["human", "AI", "Human", "ai"])


@query(r"""
  SELECT doc_id, substr(text, 1, 500) AS start,
         array_to_string(list_slice(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]'), 1, 256), ' ') AS first_tokens
  FROM documents""")
def truncated_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The truncating operator itself: 500 characters, 256 tokens."""
    tokens = F.regexp_extract_all(F.col("text"), F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"), F.lit(0))
    return table(spark, folder, "documents").select(
        "doc_id", F.substring("text", 1, 500).alias("start"), F.array_join(F.slice(tokens, 1, 256), " ").alias("first_tokens")
    )


@query("""
  SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS row_no FROM documents""")
def renumbered_rows(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.renumber(table(spark, folder, "documents").select("doc_id", "lang"), "doc_id")


@query("""
  SELECT l_orderkey, l_linenumber, round_even(l_quantity / 16.0, 3) AS r3, round_even(l_quantity / 32.0, 4) AS r4,
         round_even(l_quantity / 64.0, 5) AS r5 FROM lineitem""")
def rounded_values(spark: SparkSession, folder: str) -> DataFrame:
    """Odd quantities over a power of two lie exactly between two roundings."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", *[half_even(F.col("l_quantity") / 2.0 ** (d + 1), d).alias(f"r{d}") for d in (3, 4, 5)]
    )


# ---- chat --------------------------------------------------------------------------------------

@query(f"""
  WITH s AS (SELECT *, lower(split_part({strip_sql('text')}, ' ', 1)) AS command FROM conversations
             WHERE {strip_sql('text')} <> ''),
  c AS (SELECT conv_id, min(turn) AS stop FROM s WHERE role = 'user' AND command IN ({quoted(STOP_COMMANDS)}) GROUP BY conv_id)
  SELECT s.conv_id, turn, role, text FROM s LEFT JOIN c USING (conv_id) WHERE stop IS NULL OR turn < stop""")
def gated_turns(spark: SparkSession, folder: str) -> DataFrame:
    """The first word of a turn is its command."""
    command = F.split_part(t.strip(F.col("text")), F.lit(" "), F.lit(1))
    return chat.gate_turns(table(spark, folder, "conversations"), stop_words=STOP_COMMANDS, command=command)


@query("""
  SELECT conv_id, turn, role, text,
         row_number() OVER w - 1 AS history_turns,
         CAST(coalesce(sum(length(text)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS history_chars,
         lag(role) OVER w AS prev_role, lag(text) OVER w AS prev_text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def conversation_history(spark: SparkSession, folder: str) -> DataFrame:
    return chat.history(table(spark, folder, "conversations"))


@query(f"""
  WITH k AS (SELECT string_agg('Region: ' || r_name, chr(10) ORDER BY r_regionkey) AS knowledge FROM region)
  SELECT conv_id, turn, replace(replace('{{system}}' || chr(10) || chr(10) || 'User question:' || chr(10) || '{{question}}',
         '{{system}}', replace('{chat.GROUNDED_PROMPT.replace("'", "''")}', '{{knowledge}}', knowledge)), '{{question}}', text) AS prompt
  FROM conversations, k WHERE role = 'user'""")
def grounded_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """The five rows of region are the knowledge text, user turns are the questions."""
    line = F.concat(F.lit("Region: "), "r_name").alias("line")
    lines = gathered(table(spark, folder, "region"), F.struct("r_regionkey", line)).select(
        F.transform(F.array_sort("entries"), lambda x: x["line"]).alias("lines")
    )
    knowledge = lines.select(F.array_join("lines", "\n")).scalar()
    asked = table(spark, folder, "conversations").where(F.col("role") == "user")
    return chat.grounded_prompts(asked, knowledge, "text").select("conv_id", "turn", "prompt")


OUTCOMES = [
    None, "400 API_KEY_INVALID", "API key not valid. Please pass one", "429 too many calls", "RESOURCE_EXHAUSTED",
    "404 Model is not there", "404 page is not there", "500",
]


@query(f"""
  WITH c AS (SELECT event_type, CASE WHEN m IS NULL THEN 'ok'
      WHEN contains(m, 'API_KEY_INVALID') OR contains(m, 'API key not valid') THEN 'bad_key'
      WHEN contains(m, '429') OR contains(m, 'RESOURCE_EXHAUSTED') THEN 'quota'
      WHEN contains(m, '404') AND contains(lower(m), 'model') THEN 'model_missing' ELSE 'other' END AS outcome
    FROM (SELECT event_type, ([{', '.join('NULL' if x is None else f"'{x}'" for x in OUTCOMES)}])[event_id % {len(OUTCOMES)} + 1] || ' ' || event_type AS m FROM events))
  SELECT event_type, outcome, count(*) AS n FROM c GROUP BY ALL""")
def outcome_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Events with an error text of every class by their number, and their type behind it."""
    texts_ = F.array(*[F.lit(x).cast("string") for x in OUTCOMES])
    message = F.concat(F.get(texts_, (F.col("event_id") % len(OUTCOMES)).cast("int")), F.lit(" "), F.col("event_type"))
    events = table(spark, folder, "events").select("event_type", t.outcome_class(message).alias("outcome"))
    return events.groupBy("event_type", "outcome").agg(F.count("*").alias("n"))


@query(rf"""
  WITH c AS (SELECT doc_id, unnest(xs) AS candidate, generate_subscripts(xs, 1) - 1 AS candidate_no
             FROM (SELECT doc_id, regexp_extract_all(text, '{TOKEN_SHAPE}') AS xs FROM documents))
  SELECT doc_id, CAST(candidate_no AS INT) AS candidate_no, candidate, CASE
      WHEN candidate IN ({quoted(vocab.KEY_PLACEHOLDERS)}) THEN 'placeholder'
      WHEN starts_with(candidate, '{vocab.CLIENT_ID_PREFIX}') THEN 'client_id'
      WHEN (starts_with(candidate, 'AIza') AND length(candidate) >= 35)
        OR (starts_with(candidate, 'AQ.') AND length(candidate) >= 20) THEN 'valid' ELSE 'invalid' END AS class
  FROM c""")
def credential_scan(spark: SparkSession, folder: str) -> DataFrame:
    return chat.credential_candidates(table(spark, folder, "documents"), "doc_id", "text", TOKEN_SHAPE)


# ---- joins -------------------------------------------------------------------------------------

@query("""
  SELECT doc_id, expected, predicted, CASE WHEN expected = predicted THEN 'CORRECT' ELSE 'MISMATCH' END AS status FROM (
    SELECT doc_id, lang AS expected, CASE WHEN contains(text, ' the ') THEN 'en' WHEN contains(text, ' der ') THEN 'de'
           WHEN contains(text, ' le ') THEN 'fr' ELSE 'es' END AS predicted FROM documents)""")
def checked_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """A rule guesses the language of a document; the language column says what was expected."""
    docs = table(spark, folder, "documents")
    has = lambda word: F.contains("text", F.lit(f" {word} "))
    guess = F.when(has("the"), "en").when(has("der"), "de").when(has("le"), "fr").otherwise("es")
    return tk.check_predictions(
        docs.select("doc_id", guess.alias("predicted")), docs.select("doc_id", F.col("lang").alias("expected")), "doc_id"
    ).select("doc_id", "expected", "predicted", "status")


@query("""
  SELECT d AS dim, count(*) AS n, round(avg(v), 6) AS mean FROM (
    SELECT unnest(embedding) AS v, 'd' || (generate_subscripts(embedding, 1) - 1) AS d FROM embeddings) GROUP BY d""")
def zipped_names(spark: SparkSession, folder: str) -> DataFrame:
    names = F.transform("embedding", lambda _, i: F.concat(F.lit("d"), i.cast("string")))
    pairs = counting.zipped(table(spark, folder, "embeddings"), [], names, F.col("embedding"), "dim", "v")
    return pairs.groupBy("dim").agg(F.count("*").alias("n"), F.round(F.avg(F.col("v").cast("double")), 6).alias("mean"))


# ---- aggregations ------------------------------------------------------------------------------

@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counting.value_counts(table(spark, folder, "documents"), "source")


@query("""SELECT lang, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM documents GROUP BY lang""")
def class_distribution(spark: SparkSession, folder: str) -> DataFrame:
    shares = counting.class_distribution(table(spark, folder, "documents"), "lang")
    return shares.withColumn("percent", F.round("percent", 6))


@query("""
  SELECT quality, toxic_0, toxic_1 FROM (
    SELECT quality, count(*) FILTER (toxic = 0) AS toxic_0, count(*) FILTER (toxic = 1) AS toxic_1 FROM labels GROUP BY quality)""")
def crosstab(spark: SparkSession, folder: str) -> DataFrame:
    table_ = counting.crosstab(table(spark, folder, "labels"), "quality", "toxic", [0, 1])
    return table_.withColumnsRenamed({"0": "toxic_0", "1": "toxic_1"})


@query(f"""
  WITH t AS ({TICKETS_SQL})
  SELECT 'doc_id' AS column, count(*) FILTER (doc_id IS NULL) AS nulls FROM t UNION ALL
  SELECT 'type', count(*) FILTER (type IS NULL) FROM t UNION ALL SELECT 'subject', count(*) FILTER (subject IS NULL) FROM t UNION ALL
  SELECT 'body', count(*) FILTER (body IS NULL) FROM t UNION ALL SELECT 'language', count(*) FILTER (language IS NULL) FROM t UNION ALL
  SELECT 'priority', count(*) FILTER (priority IS NULL) FROM t""")
def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counting.null_counts(tickets(spark, folder))


@query("""
  SELECT count(*) AS n, round(avg(length(text)), 6) AS mean, round(stddev_samp(length(text)), 6) AS std, min(length(text)) AS min,
         quantile_cont(length(text), 0.25) AS q25, quantile_cont(length(text), 0.5) AS q50,
         quantile_cont(length(text), 0.75) AS q75, max(length(text)) AS max FROM documents""")
def length_statistics(spark: SparkSession, folder: str) -> DataFrame:
    stats = counting.summary_statistics(table(spark, folder, "documents").select(F.length("text").alias("length")), ["length"])
    return stats.drop("column").withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6), **_whole("min", "max")})


def _whole(*columns: str) -> dict[str, Column]:
    return {c: F.col(c).cast("long") for c in columns}


_PRICES = {"lineitem": ["l_quantity", "l_extendedprice", "l_discount"], "orders": ["o_totalprice", "o_custkey"]}


@query(" UNION ALL ".join(f"""
  SELECT '{c}' AS column, count(v) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 4) AS std, min(v) AS min, round(quantile_cont(v, 0.25), 6) AS q25,
         round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75, max(v) AS max
  FROM (SELECT {c}::DOUBLE AS v FROM {t})""" for t, columns in _PRICES.items() for c in columns))
def column_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of numeric columns of any kind, all columns of a table together."""
    found = [counting.summary_statistics(table(spark, folder, t), columns) for t, columns in _PRICES.items()]
    digits = {"mean": 6, "std": 4, "q25": 6, "q50": 6, "q75": 6}
    return found[0].unionByName(found[1]).withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("""
  WITH d AS (SELECT lang, length(text)::DOUBLE AS v, min(length(text)) OVER (PARTITION BY lang)::DOUBLE AS lo,
                    max(length(text)) OVER (PARTITION BY lang)::DOUBLE AS hi FROM documents)
  SELECT lang, CAST(least(floor((v - lo) / ((hi - lo) / 30)), 29) AS INT) AS bin, count(*) AS n FROM d GROUP BY ALL""")
def length_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return counting.histogram(table(spark, folder, "documents"), "lang", F.length("text"))


@query("""
  WITH s AS (SELECT source, lang, round(avg(n_chars), 5) AS score FROM documents GROUP BY ALL),
  w AS (SELECT source, coalesce(max(score) FILTER (lang = 'de'), 0) AS de, coalesce(max(score) FILTER (lang = 'en'), 0) AS en,
               coalesce(max(score) FILTER (lang = 'es'), 0) AS es, coalesce(max(score) FILTER (lang = 'fr'), 0) AS fr FROM s GROUP BY source)
  SELECT source, de, en, es, fr, round((de + en + es + fr) / 4, 5) AS mean FROM w""")
def wide_means(spark: SparkSession, folder: str) -> DataFrame:
    """Mean length by source in long form, spread over one column per language."""
    scores = table(spark, folder, "documents").groupBy("source", "lang").agg(F.round(F.avg("n_chars"), 5).alias("score"))
    wide = counting.wide_means(scores, "source", "lang", "score", ["de", "en", "es", "fr"])
    return wide.withColumn("mean", F.round("mean", 5))


@query("""
  SELECT count(*) AS total, count(*) FILTER (lang = 'en') AS english, count(*) FILTER (n_chars > 1000) AS long_texts,
         round(count_if(n_chars > 1000) / count(*), 9) AS share FROM documents""")
def conditional_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").agg(
        F.count("*").alias("total"), F.count_if(F.col("lang") == "en").alias("english"),
        F.count_if(F.col("n_chars") > 1000).alias("long_texts"),
    )
    return docs.withColumn("share", F.round(ratio(F.col("long_texts"), F.col("total")), 9))


@query("""
  SELECT priority, n, round(sum(n) OVER () / (count(*) OVER () * n), 9) AS weight FROM (
    SELECT CASE WHEN toxic = 1 THEN 'high' WHEN quality = 0 THEN 'low' ELSE 'medium' END AS priority, count(*) AS n
    FROM labels GROUP BY 1)""")
def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    priority = F.when(F.col("toxic") == 1, "high").when(F.col("quality") == 0, "low").otherwise("medium")
    labelled = table(spark, folder, "labels").select(priority.alias("priority"))
    return split.class_weights(labelled, "priority").withColumn("weight", F.round("weight", 9))


@query("""
  SELECT source, score FROM (
    SELECT source, round(avg(n_chars), 4) AS score, row_number() OVER (ORDER BY round(avg(n_chars), 4) DESC, min(doc_id)) AS r
    FROM documents GROUP BY source) WHERE r = 1""")
def best_source(spark: SparkSession, folder: str) -> DataFrame:
    """The source with the longest texts, the first listed among equals."""
    scores = table(spark, folder, "documents").groupBy("source").agg(
        F.round(F.avg("n_chars"), 4).alias("score"), F.min("doc_id").alias("listed")
    )
    return counting.best_of(scores, "source", "score", "listed")


@query("""
  SELECT lang, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std FROM (
    SELECT lang, doc_id % 5 AS fold, avg(n_chars) AS score FROM documents GROUP BY ALL) GROUP BY lang""")
def fold_statistics(spark: SparkSession, folder: str) -> DataFrame:
    scores = table(spark, folder, "documents").groupBy("lang", (F.col("doc_id") % 5).alias("fold")).agg(
        F.avg("n_chars").alias("score")
    )
    stats = counting.fold_statistics(scores, "lang", "score")
    return stats.select("lang", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(r"""
  SELECT doc_id, CAST(len(words) AS INT) AS n_words, CAST(len(list_distinct(words)) AS INT) AS n_distinct FROM (
    SELECT doc_id, list_filter(string_split_regex(lower(text), '\s+'), lambda w: w <> '') AS words FROM documents)""")
def distinct_words(spark: SparkSession, folder: str) -> DataFrame:
    split_once = texts(spark, folder).select("doc_id", t.split_words(F.col("text")).alias("w"))
    return split_once.select("doc_id", F.size("w").alias("n_words"), F.size(F.array_distinct("w")).alias("n_distinct"))


# ---- splits ------------------------------------------------------------------------------------

def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "lang")


@query("""
  SELECT doc_id, lang, CASE WHEN r <= (n * 80 + 50) // 100 THEN 'train' WHEN r <= (n * 90 + 50) // 100 THEN 'val' ELSE 'test' END AS split
  FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || doc_id)) AS r,
               count(*) OVER (PARTITION BY lang) AS n FROM documents)""")
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    return split.stratified_split(_labelled(spark, folder), "lang", "doc_id", {"train": 80, "val": 10, "test": 10})


@query("""
  SELECT doc_id, lang, CAST((r > n // 5)::INT + (r > n * 2 // 5)::INT + (r > n * 3 // 5)::INT + (r > n * 4 // 5)::INT AS INT) AS fold
  FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || doc_id)) AS r,
               count(*) OVER (PARTITION BY lang) AS n FROM documents)""")
def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    return split.stratified_folds(_labelled(spark, folder), "lang", "doc_id")


# ---- sorts and limits --------------------------------------------------------------------------

@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 12")
def longest_texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(12)


@query("SELECT doc_id, source FROM documents ORDER BY md5('7|' || doc_id), doc_id LIMIT 10")
def random_sample(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.sample_rows(table(spark, folder, "documents").select("doc_id", "source"), "doc_id", 10, seed=7)


@query("SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 10")
def preview(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.preview(table(spark, folder, "documents").select("doc_id", "text"), "doc_id", 10)


# ---- words -------------------------------------------------------------------------------------

_WORDS_SQL = r"""
  SELECT w AS word, count(*) AS n FROM (
    SELECT unnest(string_split_regex(lower(text), '\s+')) AS w FROM documents) WHERE w <> '' GROUP BY w"""
_LETTER_WORDS_SQL = r"""
  SELECT w AS word, count(*) AS n FROM (
    SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM documents) GROUP BY w"""


@query(_WORDS_SQL)
def word_counts(spark: SparkSession, folder: str) -> DataFrame:
    return words.word_counts(texts(spark, folder), "text")


def _case(affixes: list[str], test: str) -> str:
    whens = [f"WHEN {test}(word, '{a}') AND length(word) > {len(a) + 1} THEN '{a}'" for a in t.longest_first(affixes)]
    return "CASE " + " ".join(whens) + " END"


@query(f"""
  WITH a AS (SELECT word, {_case(vocab.PREFIXES, 'starts_with')} AS prefix, {_case(vocab.SUFFIXES, 'ends_with')} AS suffix
             FROM ({_LETTER_WORDS_SQL}))
  SELECT word, prefix, suffix, CASE
    WHEN prefix IS NOT NULL AND suffix IS NOT NULL THEN 'both prefix (''' || prefix || ''') and suffix (''' || suffix || ''')'
    WHEN prefix IS NOT NULL THEN 'prefix (''' || prefix || ''')' WHEN suffix IS NOT NULL THEN 'suffix (''' || suffix || ''')'
    ELSE 'neither' END AS affix_class, CASE
    WHEN prefix IS NOT NULL AND suffix IS NOT NULL THEN 'both (''' || prefix || ''' + ''' || suffix || ''')'
    WHEN prefix IS NOT NULL THEN 'prefix (''' || prefix || ''')' WHEN suffix IS NOT NULL THEN 'suffix (''' || suffix || ''')'
    ELSE 'neither' END AS short_class FROM a""")
def affix_classes(spark: SparkSession, folder: str) -> DataFrame:
    found = words.affixes(words.letter_word_counts(texts(spark, folder), "text"))
    short = t.affix_class(F.col("prefix"), F.col("suffix"), short=True)
    return found.select("word", "prefix", "suffix", "affix_class", short.alias("short_class"))


@query(f"""
  WITH a AS (SELECT word, n, {_case(vocab.SUFFIXES, 'ends_with')} AS suffix FROM ({_LETTER_WORDS_SQL})),
  r AS (SELECT word, n, substr(word, 1, length(word) - coalesce(length(suffix), 0)) AS root FROM a)
  SELECT root, string_agg(word, ',' ORDER BY word) AS members, count(*) AS size, CAST(sum(n) AS BIGINT) AS uses FROM r GROUP BY root""")
def suffix_families(spark: SparkSession, folder: str) -> DataFrame:
    counted = words.letter_word_counts(texts(spark, folder), "text")
    grouped = words.families(counted, words.suffix_key(F.col("word")))
    return grouped.withColumn("members", F.array_join("members", ",")).orderBy("root")


@query(PORTER_SQL.format(words=_LETTER_WORDS_SQL) + "SELECT word, stem FROM stems")
def word_stems(spark: SparkSession, folder: str) -> DataFrame:
    return add_stems(words.letter_word_counts(texts(spark, folder), "text")).select("word", "stem")


@query(PORTER_SQL.format(words=_LETTER_WORDS_SQL) + """
  SELECT stem AS root, string_agg(word, ',' ORDER BY word) AS members, count(*) AS size, CAST(sum(n) AS BIGINT) AS uses
  FROM stems GROUP BY stem""")
def word_families(spark: SparkSession, folder: str) -> DataFrame:
    grouped = words.stem_families(words.letter_word_counts(texts(spark, folder), "text"))
    return grouped.withColumn("members", F.array_join("members", ",")).orderBy("root")


@query(f"""SELECT word, n FROM ({_LETTER_WORDS_SQL}) WHERE word NOT IN ({quoted(vocab.STOPWORDS)})""")
def without_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    return words.without_stopwords(words.letter_word_counts(texts(spark, folder), "text"))


def _phrases_sql(phrases: list[str]) -> str:
    padded = f"(' ' || lower({strip_sql('text')}) || ' ')"
    return " + ".join(f"(length({padded}) - length(replace({padded}, ' {p} ', ''))) // {len(p) + 2}" for p in phrases)


@query(f"""SELECT doc_id, CAST({_phrases_sql(TEST_HEDGES)} AS INT) AS hedges, CAST({_phrases_sql(TEST_DISCOURSE)} AS INT) AS discourse,
                  CAST({_phrases_sql(vocab.HEDGES + vocab.DISCOURSE)} AS INT) AS default_phrases FROM documents""")
def phrase_counts(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    return texts(spark, folder).select(
        "doc_id", t.phrase_count(text, TEST_HEDGES).alias("hedges"), t.phrase_count(text, TEST_DISCOURSE).alias("discourse"),
        t.phrase_count(text, vocab.HEDGES + vocab.DISCOURSE).alias("default_phrases"),
    )


@query("""
  WITH x AS (SELECT vec_id, embedding::DOUBLE[] AS z FROM embeddings),
  e AS (SELECT vec_id, z, list_transform(z, lambda v: exp(v - list_max(z))) AS e FROM x),
  p AS (SELECT vec_id, z, list_transform(e, lambda v: v / list_sum(e)) AS p FROM e)
  SELECT vec_id, CAST(component - 1 AS INT) AS component, round(share, 6) AS share, component = list_position(z, list_max(z)) AS predicted
  FROM (SELECT vec_id, z, unnest(p) AS share, generate_subscripts(p, 1) AS component FROM p)""")
def softmax_scores(spark: SparkSession, folder: str) -> DataFrame:
    """All components of a vector as logits."""
    logits = F.transform("embedding", lambda x: x.cast("double"))
    p = table(spark, folder, "embeddings").select("vec_id", logits.alias("z"))
    rows = p.select("vec_id", argmax(F.col("z")).cast("int").alias("best"), F.posexplode(softmax(F.col("z"))).alias("component", "share"))
    return rows.select("vec_id", "component", F.round("share", 6).alias("share"), (F.col("component") == F.col("best")).alias("predicted"))
