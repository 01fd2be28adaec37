"""Streaming queries, run over the files that are there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.operators import models
from corpusloom.plans.corpus_queries import STOP_COMMANDS, quoted
from corpusloom.plans.model_queries import ticket_split
from corpusloom.plans.registry import SQL, query, strip_sql, table
from corpusloom.plans.token_queries import TEST_SPANS
from corpusloom.session import scratch_path
from corpusloom.streaming import conversations, jobs

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    """Spread over the cores only when the files there make fewer partitions than cores."""
    cores = spark.sparkContext.defaultParallelism
    few = table(spark, folder, "documents").rdd.getNumPartitions() <= cores
    return jobs.file_stream(spark, folder, "documents.parquet", DOCUMENTS, partitions=4 * cores if few else None)


@query(SQL["token_lists"])
def stream_token_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Documents tagged as they arrive."""
    arriving = _documents(spark, folder).select(F.col("doc_id").alias("message_id"), F.col("text").alias("raw_text"))
    lists = jobs.message_tagging(arriving, TEST_SPANS)
    joined = lists.select(
        "message_id", F.array_join("loc_tokens", " ").alias("loc_tokens"), F.array_join("act_tokens", " ").alias("act_tokens")
    )
    return jobs.run_available(joined, "stream-tags")


@query()
def stream_ticket_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Tickets scored as they arrive with a model fitted on the labelled ones."""
    model, _ = models.fit_priority_model(ticket_split(spark, folder))
    arriving = _documents(spark, folder).select(
        "doc_id", F.col("source").alias("type"), F.substring_index("text", "\n", 1).alias("subject"),
        F.when(F.contains("text", F.lit("\n")), F.expr("substring(text, instr(text, '\n') + 1)")).alias("body"),
        F.lit(None).cast("string").alias("text"),
    )
    scores = jobs.ticket_scoring(arriving, model, ["doc_id"]).select("doc_id", "predicted_priority", "confidence", "probabilities.*")
    return jobs.run_available(scores, "stream-scores")


@query(f"""
  WITH s AS (SELECT *, lower(split_part({strip_sql('text')}, ' ', 1)) AS command FROM conversations WHERE {strip_sql('text')} <> ''),
  c AS (SELECT conv_id, min(turn) AS stop FROM s WHERE role = 'user' AND command IN ({quoted(STOP_COMMANDS)}) GROUP BY conv_id)
  SELECT v.conv_id, v.n AS version, CAST(c.stop AS BIGINT) AS stop, count(s.turn) AS kept_turns, CAST(coalesce(sum(length(s.text)), 0) AS BIGINT) AS kept_chars,
         CAST(max(s.turn) AS BIGINT) AS last_turn
  FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id) v LEFT JOIN c USING (conv_id)
    LEFT JOIN s ON s.conv_id = v.conv_id AND (c.stop IS NULL OR s.turn < c.stop) GROUP BY v.conv_id, v.n, c.stop""")
def stream_conversation_states(spark: SparkSession, folder: str) -> DataFrame:
    """What is known of each conversation after its turns have arrived in four batches, in no order."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    path = scratch_path(spark, "arriving")
    turns.repartition(4, F.xxhash64("conv_id", "turn")).write.parquet(path)
    arriving = jobs.file_stream(spark, path, "*.parquet", turns.schema, files_per_batch=1)
    command = F.substring_index(t.strip(F.col("text")), " ", 1)
    states = conversations.conversation_states(arriving, stop_words=STOP_COMMANDS, command=command)
    return conversations.present_states(jobs.run_available(states, "stream-states"))
