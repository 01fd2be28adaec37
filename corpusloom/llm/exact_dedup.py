"""Exact deduplication with built-in expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import id_and_text
from corpusloom.session import materialise

KEEP = {"smallest": F.min, "largest": F.max}


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] = lambda text: text,
) -> DataFrame:
    """For every row the id that stays for its text: ``id_col, keep_id, group_size, kept, text_sha256``.

    Rows are grouped by the 128-bit hash of the normalised text and, inside a hash, by the bytes
    themselves, so texts that only share a hash stay apart. The grouping is combined before the
    shuffle: a text with any number of copies leaves each task once. Rows then look up their group
    by the hash alone; the rare hash with several texts is looked up with its text.

    - null text: counts as empty, and all empty texts are one group
    - null ids: below every other id when ``keep="largest"``, above them when ``"smallest"``;
      a group of null ids only has a null ``keep_id`` and keeps them all
    - repeated rows of one id: each counts in ``group_size``; all with the kept id are kept
    - an empty table gives an empty result; other columns are ignored
    """
    choose = KEEP[keep]
    rows = id_and_text(docs, id_col, text_col).withColumn("text", normalise(F.col("text")))
    rows = rows.withColumn("hash", F.unhex(F.md5("text")))
    classes = rows.groupBy("hash", "text").agg(F.count("*").alias("size"), choose("id").alias("keep"))
    hashes = classes.groupBy("hash").agg(
        F.count("*").alias("texts"), F.max("size").alias("size"), choose("keep").alias("keep")
    )
    groups = materialise(hashes.where("size > 1 OR texts > 1"), "exact-groups")
    marked = rows.select("id", "hash", F.sha2("text", 256).alias("sha"))
    collided = groups.where("texts > 1")
    if collided.isEmpty():
        joined = marked.join(groups, "hash", "left")
    else:
        apart = rows.join(collided.select("hash"), "hash", "left_semi")
        exact = apart.groupBy("hash", "text").agg(F.count("*").alias("size"), choose("id").alias("keep"))
        several = apart.select("id", "hash", "text").join(exact, ["hash", "text"]).select(
            "hash", "id", F.sha2("text", 256).alias("sha"), F.lit(2).cast("long").alias("texts"), "size", "keep"
        )
        single = marked.join(collided.select("hash"), "hash", "left_anti")
        joined = single.join(groups, "hash", "left").select(*several.columns).unionByName(several)
    keep_id = F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep"))
    return joined.select(
        F.col("id").alias(id_col),
        keep_id.alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
