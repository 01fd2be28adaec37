"""The registered queries of this subpackage, with SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import warc
from corpusloom.llm.archive import archive_pages, archived_pages
from corpusloom.llm.collocations import collocations
from corpusloom.llm.common import table
from corpusloom.llm.exact_dedup import exact_duplicates
from corpusloom.llm.jaccard_join import jaccard_components
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.quality import quality_rules
from corpusloom.llm.secrets import find_secrets, fit_markov, labelled_strings
from corpusloom.llm.simhash import simhash_components
from corpusloom.llm.substring_dedup import remove_repeated
from corpusloom.llm.tokens import decode_documents, encode_documents, packed
from corpusloom.llm.toxicity import toxicity
from corpusloom.llm.urls import alias_edges, url_verdicts
from corpusloom.llm.whitening import whitened_embeddings
from corpusloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


@query()
def op1_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = remove_repeated(table(spark, folder, "documents"), width=50)
    lengths = F.transform("spans", lambda s: s["end"] - s["start"])
    return rows.select(
        "doc_id", "n_bytes", F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"), keep="largest")


@query()
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokens = encode_documents(table(spark, folder, "documents"), RANKS, PATTERN)
    return decode_documents(tokens, RANKS, PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(packed(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op4_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return url_verdicts(pages, alias_edges(pages), URL_RULES)


@query()
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), RANKS, PATTERN, end_id=2, capacity=1024, tokenizer_path=TOKENIZER)


@query()
def op6_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rows = find_secrets(docs, fit_markov(labelled_strings(docs)))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query(r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN sizes USING (doc_id)""")
def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"), words_each=3, percent=90)


@query()
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly"
    )


@query()
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    warc.register(spark)
    path = scratch_path(spark, "warc")
    archive_pages(table(spark, folder, "pages"), path, min_bytes=0)
    return archived_pages(spark, path)


@query()
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(r"""
WITH words AS (
  SELECT lang, len(w) AS m, w FROM (
    SELECT lang, regexp_extract_all(unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                              '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents)) WHERE len(w) > 0),
counted AS (
  SELECT lang, phrase, size, count(*) AS f FROM (
    SELECT lang, 1 AS size, unnest(w) AS phrase FROM words
    UNION ALL SELECT lang, 2, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, m)]) FROM words
    UNION ALL SELECT lang, 3, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, m - 1)]) FROM words) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang),
nodes AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE f >= 10),
cuts AS (
  SELECT lang, phrase, size, w, f AS a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM nodes WHERE size > 1)),
scored AS (
  SELECT c.lang, c.phrase, c.a, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f))::BIGINT AS score, k
  FROM cuts c JOIN nodes l ON l.lang = c.lang AND l.phrase = first JOIN nodes r ON r.lang = c.lang AND r.phrase = rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM nodes WHERE size = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer g USING (lang, phrase) WHERE g.f IS NULL OR 100 * g.f < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
JOIN totals USING (lang) WHERE rank <= 2000""")
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"), max_words=3, min_count=10, top=2000)


@query()
def op12_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_components(table(spark, folder, "documents"), words_each=3, distance=3)


@query()
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened_embeddings(table(spark, folder, "embeddings"), components=8)
