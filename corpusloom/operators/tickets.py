"""Support tickets: requests, text, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.functions import vocab
from corpusloom.functions.arrays import explode_rows
from corpusloom.operators.split import label_codes

REQUEST_SCHEMA = "tickets array<struct<type:string,subject:string,body:string,text:string>>"


def training_tickets(tickets: DataFrame, language: str = "en") -> DataFrame:
    """Tickets of one language with text and label code; rows without a known label are dropped."""
    kept = tickets.where(F.col("language") == language)
    text = t.ticket_text(F.col("type"), F.col("subject"), F.col("body"))
    coded = kept.withColumn("text", text).withColumn("label", label_codes(F.col("priority"), vocab.PRIORITY_CODES))
    return coded.dropna(subset=["label", "text"]).withColumn("label", F.col("label").cast("int"))


def scoring_text(tickets: DataFrame, kind: str = "type", subject: str = "subject", body: str = "body", text: str = "text") -> DataFrame:
    """Set ``text`` to the given text, or else to the one built from the parts; blank tickets are dropped."""
    parts = [F.col(kind), F.col(subject), F.col(body)]
    given = t.strip(t.text_or_blank(F.col(text)))
    built = t.ticket_text(*parts, strip_parts=True)
    empty = (given == "") & t.blank(parts[0]) & t.blank(parts[1]) & t.blank(parts[2])
    return tickets.where(~empty).withColumn(text, F.when(given != "", given).otherwise(built))


def parse_requests(requests: DataFrame, keys: list[str], body: Column) -> DataFrame:
    """One row per ticket of a JSON batch request."""
    rows = explode_rows(requests, keys, F.from_json(body, REQUEST_SCHEMA)["tickets"], "_t", "ticket_no")
    return rows.select(*keys, "ticket_no", "_t.*")


def check_predictions(predicted: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """CORRECT or MISMATCH for every expected label."""
    status = F.when(F.col("predicted") == F.col("expected"), "CORRECT").otherwise("MISMATCH")
    return expected.join(predicted, key).withColumn("status", status)
