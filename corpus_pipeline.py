"""A corpus made ready for training: toxic texts out, copies out, secrets masked, the rest packed.

Each stage reads what the stage before kept and is written before the next one starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import named, table
from corpusloom.llm.exact_dedup import exact_duplicates
from corpusloom.llm.jaccard_join import jaccard_components
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.queries import PATTERN, RANKS, TOKENIZER
from corpusloom.llm.secrets import fit_markov, labelled_strings, mask_secrets
from corpusloom.llm.toxicity import learn_toxicity, toxic_score
from corpusloom.session import materialise

#: No SQL: three stages learn a model or search for packings.
ORACLE_SQL = None
#: The row number given where ids do not tell rows apart; no stage returns it.
ROW = "__row"


def told_apart(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents and a column that is different in every row: the id, or a number if ids repeat or are null.

    Numbers are fixed by writing the rows once.
    """
    ids = docs.select(named("doc_id").alias("id"))
    if ids.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 OR id IS NULL").isEmpty():
        return docs, "doc_id"
    return materialise(docs.withColumn(ROW, F.monotonically_increasing_id()), "stage-rows"), ROW


def without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows whose key is not in ``gone``, with the columns of documents."""
    kept = docs.join(materialise(gone.select(key), "stage-gone"), key, "left_anti")
    return kept.select(*[named(c) for c in docs.columns if c != ROW])


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier does not call toxic; null ids and texts are scored like any other."""
    model = learn_toxicity(docs, table(spark, folder, "labels"))
    return docs.where(toxic_score(spark, named("text"), model) < 0.5)


def distinct_texts(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row per text, that of the smallest id; null counts as empty."""
    rows, key = told_apart(docs)
    return without(rows, key, exact_duplicates(rows, key, "text", keep="smallest").where("NOT kept"))


def distinct_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row per group of near copies: five-word shingles, similarity of 0.8 or more, linked in chains."""
    rows, key = told_apart(docs)
    groups = jaccard_components(rows, 5, 80, key, "text")
    return without(rows, key, groups.where(F.col("component_id") != F.col(key)))


def without_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with secrets in the text masked and ``n_chars`` counted anew."""
    model = fit_markov(labelled_strings(docs))
    masked = mask_secrets(docs, model)
    return masked.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes).get("n_chars", "long")))


def packed_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every piece of every document with its token ids and its place in a sequence of at most 1,024 tokens."""
    return pack_documents(docs, RANKS, PATTERN, end_id=2, capacity=1024, keep_ids=True, tokenizer_path=TOKENIZER)


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("exact_dedup", distinct_texts),
    ("ngram_jaccard_join", distinct_documents),
    ("secret_scans", without_secrets),
    ("best_fit_packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
