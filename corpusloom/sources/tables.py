"""Readers and writers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.lookups import gathered


def _declared(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def empty(spark: SparkSession, schema: str | StructType) -> DataFrame:
    return spark.createDataFrame([], _declared(schema))


def literal_table(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """A small table written in code."""
    return spark.createDataFrame(rows, _declared(schema))


def _csv(spark: SparkSession):
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"')


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A CSV file with a header, by column name; quoted fields may hold line breaks.

    The header is checked against the schema: a missing column is an error, other columns are
    dropped, the order does not matter.
    """
    wanted = _declared(schema)
    found = _csv(spark).csv(path)
    require_columns(found, wanted.names, path)
    by_name = {f.name: f for f in wanted.fields}
    full = StructType()
    for name in found.columns:
        full.add(name, by_name[name].dataType if name in by_name else "string")
    return _csv(spark).schema(full).csv(path).select(*wanted.names)


def require_columns(df: DataFrame, required: list[str], name: str = "table") -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{name} missing columns: {missing}")
    return df


def read_optional(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The CSV table, or an empty table of the same schema when there is no such file."""
    try:
        return read_csv(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; quotes inside a field are doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with the whole text in ``value``; an empty text when there is no file."""
    try:
        return spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return literal_table(spark, [("",)], "value string")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.schema(_declared(schema)).json(path)


def summary_row(metrics: DataFrame, importances: DataFrame, alignment: DataFrame, top: int = 8) -> DataFrame:
    """Metrics by model, the top features and the cluster alignment as one nested row."""
    best = importances.orderBy(F.desc("importance"), "feature").limit(top)
    scores = F.struct("model", "accuracy", "precision", "recall", "f1")
    models = gathered(metrics, scores).select(F.array_sort("entries").alias("classification"))
    features = best.agg(F.map_from_entries(F.collect_list(F.struct("feature", "importance"))).alias("m")).scalar()
    aligned = alignment.select(F.struct("kmeans_ari", "hierarchical_ari").alias("a")).scalar()
    return models.withColumn("top_features", features).withColumn("cluster_alignment", aligned)


def summary_entries(summary: DataFrame) -> DataFrame:
    """(part, name, field, value) for every number of a nested summary."""
    scores = summary.select(F.inline("classification"))
    fields = [c for c in scores.columns if c != "model"]
    scores = scores.unpivot("model", fields, "field", "value").select(F.lit("classification").alias("part"), F.col("model").alias("name"), "field", "value")
    features = summary.select(F.explode("top_features").alias("name", "value"))
    features = features.select(F.lit("top_features").alias("part"), "name", F.lit("importance").alias("field"), "value")
    aligned = summary.select("cluster_alignment.*")
    aligned = aligned.unpivot([], aligned.columns, "name", "value").select(
        F.lit("cluster_alignment").alias("part"), "name", F.lit("ari").alias("field"), "value")
    return scores.unionByName(features).unionByName(aligned)
