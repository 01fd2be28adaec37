"""SimHash near-duplicates: fingerprints compared around the anchor points of covering codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import id_and_text, lean
from corpusloom.llm.components import components
from corpusloom.llm.jaccard_join import LOWER
from corpusloom.session import materialise

SEED = 42
BITS = 64
#: Pairs at this distance or less differ by one bit at most in one half, and, in the other half, in one of its quarters.
MAX_DISTANCE = 3
BLOCK = 1 << 16


def fingerprint(text: str, words_each: int) -> int:
    """The SimHash of the shingles of ``words_each`` words, repeats included; 0 without words."""
    words = text.encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return 0
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = ends - lengths, ends[min(words_each, len(words)) - 1 :]
    joined, ones = b" ".join(words), np.zeros(BITS, np.int64)
    for at in range(0, len(ends), BLOCK):
        bounds = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in bounds], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(ends), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_each: int, id_col: str, text_col: str) -> DataFrame:
    """``id, print``; the fingerprint is a long with the same 64 bits."""

    @F.pandas_udf("long")
    def printed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in lean(parts):
            yield pd.Series(np.array([fingerprint(t, words_each) for t in texts], np.uint64).view(np.int64))

    return id_and_text(docs, id_col, text_col).select("id", printed("text").alias("print"))


def anchors(bits: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors within reach of every number of ``width`` bits: its index, an anchor, and whether that is its home.

    ``width`` is a power of two. The anchors are the words of the Hamming code on all bits but the
    highest, which is kept as it is: every point is within one flip of exactly one of them, its home.
    Those within that radius plus one flip are the home itself with the highest bit flipped, and
    the words two flips away: for each place, the place that completes it to a code word.
    """
    places = np.arange(width, dtype=np.uint64)  # counted from 1; 0 is no place
    masks = np.where(places > 0, np.uint64(1) << np.maximum(places, 1) - np.uint64(1), np.uint64(0))
    at = np.zeros(len(bits), np.uint64)
    for k in range(width.bit_length() - 1):
        check = np.bitwise_or.reduce(masks[(places >> np.uint64(k)) & np.uint64(1) > 0])
        at |= (np.bitwise_count(bits & check) & 1).astype(np.uint64) << np.uint64(k)
    other = places[None, :] ^ at[:, None]
    row, place = np.nonzero((places[None, :] < other) | ((places[None, :] == 0) & (at[:, None] == 0)))
    near = bits[row] ^ masks[place] ^ masks[other[row, place]]
    top = bits ^ masks[at] ^ np.uint64(1 << (width - 1))
    row = np.concatenate([row, np.arange(len(bits))])
    return row, np.concatenate([near, top]), np.concatenate([place == 0, np.zeros(len(bits), bool)])


def part(prints: np.ndarray, index: int | np.ndarray, width: int) -> np.ndarray:
    """The bits ``index * width`` and on."""
    return prints >> np.asarray(index * width, np.uint64) & np.uint64((1 << width) - 1)


def at_halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints to ``print, cell, home``: all anchors of both halves; the half is bit 32 of the cell."""
    for batch in batches:
        prints = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
        for half in (0, 1):
            row, anchor, home = anchors(part(prints, half, 32), 32)
            cell = (anchor | np.uint64(half << 32)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints[row].view(np.int64)), pa.array(cell), pa.array(home)], ["print", "cell", "home"])


def at_quarters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of crowded cells at all anchors of the two quarters of the half that their cell leaves open."""
    for batch in batches:
        prints, cell = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("print", "cell"))
        home = batch.column("home").to_numpy(zero_copy_only=False)
        open_half = 1 - (cell >> 32)
        for quarter in (0, 1):
            row, anchor, nearest = anchors(part(prints.view(np.uint64), 2 * open_half + quarter, 16), 16)
            sub = (anchor | np.uint64(quarter << 16)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints[row]), pa.array(cell[row]), pa.array(sub), pa.array(nearest & home[row])],
                ["print", "cell", "sub", "home"])


def replicated(prints: DataFrame, crowd: int) -> DataFrame:
    """``print, cell, sub, home``: every fingerprint at all anchors within reach, once as home in each half.

    Two fingerprints with at most three different bits agree up to one bit in a half, so each is at
    the home of the other in that half. A cell in which more than ``crowd`` fingerprints are at home
    is divided by anchors of the two quarters of the other half, in one of which they again differ by one bit at most.
    """
    rows = materialise(prints.select("print").mapInArrow(at_halves, "print long, cell long, home boolean"), "anchored")
    crowded = rows.where("home").groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > crowd)
    rows = rows.join(materialise(crowded.select("cell", F.lit(True).alias("crowded")), "crowded"), "cell", "left")
    plain = rows.where("crowded IS NULL").select("print", "cell", F.lit(-1).cast("long").alias("sub"), "home")
    divided = rows.where("crowded").select("print", "cell", "home")
    return plain.unionByName(divided.mapInArrow(at_quarters, "print long, cell long, sub long, home boolean"))


def forest(prints: np.ndarray, home: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of one cell that connect what its links connect, fewer than it has members.

    A link joins a member at home here and any other within ``distance``. Each component is searched
    from a home; what is found is not looked at again, so many near copies cost little more than one.
    """
    left, found = np.ones(len(prints), bool), []
    for root in np.flatnonzero(home):
        if not left[root]:
            continue
        left[root], todo = False, [np.array([root])]
        while todo:
            edge = todo.pop()
            for own in (edge[home[edge]], edge[~home[edge]]):
                if not len(own):
                    continue
                open_ = np.flatnonzero(left if home[own[0]] else left & home)
                if not len(open_):
                    continue
                step = max(1, (1 << 21) // len(open_))
                if len(own) > step:
                    todo += [own[step:]]
                    own = own[:step]
                near = np.bitwise_count(prints[own][:, None] ^ prints[open_][None, :]) <= distance
                hit = near.any(0)
                if hit.any():
                    found.append((prints[own[near.argmax(0)[hit]]], prints[open_[hit]]))
                    left[open_[hit]] = False
                    todo.append(open_[hit])
    return found


def compared(distance: int):
    """Cells of a bucket (print, cell, sub, home) to links (a, b)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        prints, cell, sub = (table.column(c).to_numpy() for c in ("print", "cell", "sub"))
        home = table.column("home").to_numpy()
        order = np.lexsort([sub, cell])
        prints, cell, sub, home = prints.view(np.uint64)[order], cell[order], sub[order], home[order]
        edge = np.ones(len(order), bool)
        edge[1:] = (cell[1:] != cell[:-1]) | (sub[1:] != sub[:-1])
        starts = np.flatnonzero(edge)
        ends = np.append(starts[1:], len(order))
        useful = (ends - starts > 1) & np.logical_or.reduceat(home, starts) if len(starts) else np.zeros(0, bool)
        links = []
        for a, b in zip(starts[useful], ends[useful]):
            links += forest(prints[a:b], home[a:b], distance)
        sides = [np.concatenate([x[k] for x in links]).view(np.int64) if links else np.zeros(0, np.int64) for k in (0, 1)]
        return pa.Table.from_arrays([pa.array(s) for s in sides], schema=schema)

    return run


def simhash_components(
    docs: DataFrame,
    words_each: int = 5,
    distance: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    crowd: int = 1000,
    bucket_rows: int = 500_000,
) -> DataFrame:
    """``id_col, fingerprint, component_id`` for every row.

    A-Z is lower-cased; words are runs without ASCII white space; shingles are ``words_each`` words
    joined by blanks, a text with fewer words is one shingle. A bit of the fingerprint is set when it
    is set in over half of the XXH64 hashes of the shingles, repeats included. Rows link at ``distance``
    (0 to 3) or fewer different bits, and a component is named by the smallest id in it.

    Equal fingerprints are one. Each goes to the anchors of a covering code within the covering
    radius plus the one bit by which a partner may differ in a half, and is compared there with those that
    have the anchor as home. A cell returns a spanning forest of its links, not all pairs. Cells
    with more than ``crowd`` at home are divided by a second code, and dealt to tasks by hash; no link is lost.

    - null and empty texts, and texts without words: fingerprint zero, linked like any other
    - null ids: take part and connect; a component of null ids only has a null name
    - repeated rows of one id: each is returned, with its own fingerprint
    - an empty table gives an empty result; other columns are ignored
    """
    if not 0 <= distance <= MAX_DISTANCE:
        raise ValueError(f"distance must be 0 to {MAX_DISTANCE}")
    rows = materialise(fingerprints(docs, words_each, id_col, text_col), "fingerprints")
    groups = materialise(rows.groupBy("print").agg(F.min("id").alias("first")), "distinct-fingerprints")
    cells = materialise(replicated(groups.select("print"), crowd), "cells")
    buckets = max(1, -(-cells.count() // bucket_rows))
    bucket = F.pmod(F.xxhash64("cell", "sub"), F.lit(buckets)).alias("bucket")
    links = cells.select("*", bucket).groupBy("bucket").applyInArrow(compared(distance), "a long, b long")
    found = components(materialise(links, "links"))
    named = groups.join(found.withColumnRenamed("node", "print"), "print", "left")
    named = named.select("print", "first", F.coalesce("component", "print").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(least, "component").select("print", "component_id")
    return rows.join(materialise(named, "named-fingerprints"), "print").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
