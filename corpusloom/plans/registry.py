"""The registered queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its SQL if there is one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread a table of few files over the cores before work that is heavy per row.

    A table with at least as many partitions as cores stays as it is, so large inputs are not
    shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() > cores else df.repartition(4 * cores)


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """documents as an emergency corpus."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("message_id"), F.col("text").alias("raw_text"), "source"
    )


def responses(spark: SparkSession, folder: str) -> DataFrame:
    """conversations as a human-AI corpus: users are human, assistants are AI."""
    turns = table(spark, folder, "conversations").where(F.col("role") != "system")
    return turns.select(
        F.concat_ws("_", "conv_id", "turn").alias("response_id"),
        F.col("conv_id").alias("prompt_id"),
        F.col("text").alias("response_text"),
        F.when(F.col("role") == "user", "human").otherwise("AI").alias("source_type"),
    )


def tickets(spark: SparkSession, folder: str) -> DataFrame:
    """documents with labels as tickets; a document without labels has no priority."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    priority = F.when(F.col("toxic") == 1, "high").when(F.col("quality") == 0, "low").when(
        F.col("quality") == 1, "medium"
    )
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        F.col("source").alias("type"),
        F.substring_index("text", "\n", 1).alias("subject"),
        F.when(F.contains("text", F.lit("\n")), F.expr("substring(text, instr(text, '\n') + 1)")).alias("body"),
        F.col("lang").alias("language"),
        priority.alias("priority"),
    )


RESPONSES_SQL = """
  SELECT conv_id || '_' || turn AS response_id, conv_id AS prompt_id, text AS response_text,
         CASE WHEN role = 'user' THEN 'human' ELSE 'AI' END AS source_type
  FROM conversations WHERE role <> 'system'"""

TICKETS_SQL = """
  SELECT doc_id, source AS type, split_part(text, chr(10), 1) AS subject,
         CASE WHEN contains(text, chr(10)) THEN substr(text, instr(text, chr(10)) + 1) END AS body,
         lang AS language,
         CASE WHEN toxic = 1 THEN 'high' WHEN quality = 0 THEN 'low' WHEN quality = 1 THEN 'medium' END AS priority
  FROM documents LEFT JOIN labels USING (doc_id)"""

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def strip_sql(text: str) -> str:
    return f"trim({text}, {WS})"
