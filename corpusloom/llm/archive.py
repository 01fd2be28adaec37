"""Archiving pages as WARC records, each distinct payload once."""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusloom.llm import warc
from corpusloom.llm.common import named, small_batches
from corpusloom.session import materialise


@F.arrow_udf(StringType())
def base32(digests: pa.Array) -> pa.Array:
    return pa.array([None if d is None else base64.b32encode(bytes.fromhex(d)).decode() for d in digests.to_pylist()], pa.string())


def payload_digest(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column."""
    return base32(F.sha1(payload))


def archive_pages(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0
) -> None:
    """Write one record per row to the folder ``path``.

    Of rows with the same payload of at least ``min_bytes`` bytes, the one with the smallest id is a
    response with the payload, all others are revisits without it that refer to that id; smaller payloads are all
    responses. Payloads are the same if their SHA-1, a second 64-bit hash and their length are.

    A null html is an empty payload, a null url leaves the header out. A null id is written as an empty
    record id and is never referred to unless its group has no other; of repeated rows with the smallest id each is a response.
    """
    small_batches(pages.sparkSession)
    payload = F.coalesce(named(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(named(id_col).alias("id"), named(url_col).cast("string").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumns({"sha": F.sha1("payload"), "mixed": F.xxhash64("payload"), "size": F.octet_length("payload").cast("long")})
    key = ["sha", "mixed", "size"]
    groups = rows.where(F.col("size") >= min_bytes).groupBy(*key).agg(F.count("*").alias("n"), F.min("id").alias("first"))
    groups = materialise(groups.where("n > 1").drop("n"), "payload-groups")
    joined = rows.join(groups, key, "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    urn = lambda x: F.concat(F.lit("<urn:page:"), x.cast("string"), F.lit(">"))
    joined.select(
        F.coalesce(urn(F.col("id")), F.lit("<urn:page:>")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.concat(F.lit("sha1:"), base32("sha")).alias("payload_digest"),
        F.col("size").alias("payload_length"),
        F.when(again, urn(F.col("first"))).alias("refers_to"),
        F.when(~again, F.col("payload")).alias("payload"),
    ).write.format("warc").mode("append").save(path)


def archived_pages(spark, path: str, id_type: str = "long") -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record below ``path``.

    Length and digest of a response are taken from its payload as read back; revisits are read by their headers alone.
    """
    source = lambda columns: spark.read.format("warc").schema(columns).load(path)
    headers = "record_id string, record_type string, payload_digest string, payload_length bigint, refers_to string"
    responses = source(f"{headers}, payload binary").where("record_type = 'response'").select(
        "record_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        payload_digest(F.col("payload")).alias("payload_digest"), "record_type", "refers_to",
    )
    revisits = source(headers).where("record_type = 'revisit'").select(
        "record_id", F.col("payload_length").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type", "refers_to",
    )
    number = lambda c: F.nullif(F.regexp_extract(c, r"(?s)^<urn:page:(.*)>$", 1), F.lit("")).cast(id_type)
    return responses.unionByName(revisits).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"),
    )
