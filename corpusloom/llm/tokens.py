"""Byte-level BPE encoding and decoding of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bpe import encoder, encoding
from corpusloom.llm.common import id_and_text, lean, named


def encoded(text: Column, rank_path: str, pattern: str) -> Column:
    """The token ids (array of int) of a string column; a null or empty text has none."""

    @F.arrow_udf("array<int>")
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(rank_path, pattern)
        for part in lean(parts):
            packed = [own.encode(t or "") for t in part.to_pylist()]
            offsets = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
            ids = pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32())
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids)

    return encode(text.cast("string"))


def decoded(ids: Column, rank_path: str, pattern: str) -> Column:
    """The bytes (binary) that token ids stand for; they need not be whole UTF-8. Null gives null."""

    @F.arrow_udf("binary")
    def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoding(rank_path, pattern)
        for part in lean(parts):
            yield pa.array([None if x is None else own.decode_bytes(x) for x in part.to_pylist()], pa.binary())

    return decode(ids)


def packed(ids: Column) -> Column:
    """Token ids as little-endian unsigned 32-bit integers, one after the other."""

    @F.arrow_udf("binary")
    def pack(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in lean(parts):
            flat = part.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.cumsum(part.value_lengths().to_numpy(zero_copy_only=False)) if len(part) else []
            starts = [0, *ends[:-1]] if len(part) else []
            yield pa.array([flat[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())

    return pack(ids)


def encode_documents(
    docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, ids`` for every row: the ids tiktoken gives without special tokens.

    Null and empty texts have an empty list. Texts of any length are encoded whole, cut only where
    no match of the pattern can span. Repeated rows are each returned; other columns are ignored.
    """
    rows = id_and_text(docs, id_col, text_col)
    return rows.select(F.col("id").alias(id_col), encoded(F.col("text"), rank_path, pattern).alias("ids"))


def decode_documents(tokens: DataFrame, rank_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """All columns of ``tokens`` and ``decoded``, the bytes of its ids; null ids decode to null."""
    return tokens.withColumn("decoded", decoded(named(ids_col), rank_path, pattern))
