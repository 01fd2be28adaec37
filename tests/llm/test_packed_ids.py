"""Ids of pieces are written and shuffled in compressed form and come out whole."""

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm.packing import document_pieces, pack_documents, pack_ids, unpacked_ids
from corpusloom.llm.queries import PATTERN, RANKS, TOKENIZER


def test_packed_ids_come_back_whatever_their_size(spark):
    rng = np.random.default_rng(4)
    pieces = [rng.integers(0, top, n).tolist() for top in (2, 50_000, 65_536, 65_537, 1 << 31) for n in (0, 1, 2, 1024)] + [[65_535], [65_536]]
    rows = [(k, bytearray(pack_ids(np.array(p, "<u4").tobytes())), len(p)) for k, p in enumerate(pieces)]
    frame = spark.createDataFrame(rows, "k int, data binary, length long")
    got = {r.k: r.ids for r in frame.select("k", unpacked_ids(F.col("data"), F.col("length")).alias("ids")).collect()}
    assert got == dict(enumerate(pieces))


def test_no_plain_ids_are_shuffled(spark):
    texts = [(k, "some words that go on and on " * (40 * k)) for k in range(12)] + [(12, None), (13, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    packed = pack_documents(docs, RANKS, PATTERN, keep_ids=True, tokenizer_path=TOKENIZER)
    below = packed._jdf.queryExecution().optimizedPlan().toString().split("ArrowEvalPython", 1)[1]
    assert dict(packed.dtypes)["ids"] == "array<int>" and "unpacked" in below
    plain = {(r.doc_id, r.piece): (r.ids, r.ids_crc32) for r in document_pieces(docs, RANKS, PATTERN, keep_ids=True).collect()}
    assert {(r.doc_id, r.piece): (r.ids, r.ids_crc32) for r in packed.collect()} == plain
    written = document_pieces(docs, RANKS, PATTERN, keep_ids=True, packed=True)
    assert dict(written.dtypes)["ids"] == "binary"
    sizes = written.agg(F.sum(F.octet_length("ids")), F.sum("length")).first()
    assert sizes[0] < sizes[1]
