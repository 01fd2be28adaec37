"""Packing documents into token sequences with a grouping genetic algorithm."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bpe import added_tokens, encoder
from corpusloom.llm.common import id_and_text, lean
from corpusloom.session import materialise

Bins = list[list[int]]


def document_pieces(
    docs: DataFrame,
    rank_path: str,
    pattern: str,
    end_id: int = 2,
    capacity: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
    tokenizer_path: str | None = None,
    packed: bool = False,
) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32`` of every document's tokens with ``end_id`` behind them.

    A document of more than ``capacity`` tokens is cut into pieces of ``capacity``; the first takes
    the rest and may be shorter. A null or empty text is the end token alone. ``keep_ids`` adds the
    ids of each piece (array of int; ``packed``: bytes that ``unpacked_ids`` reads). A text that holds an added token of the file ``tokenizer_path``, such as
    an end mark, is encoded by that tokenizer; all others have the same ids either way.
    """
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.binary() if packed else pa.list_(pa.int32()))] if keep_ids else []
    spelled = "piece int, start long, length long, ids_crc32 long" + (f", ids {'binary' if packed else 'array<int>'}" if keep_ids else "")
    kept = pack_ids if packed else lambda piece: np.frombuffer(piece, "<i4")
    end = end_id.to_bytes(4, "little")

    @F.arrow_udf(f"array<struct<{spelled}>>")
    def cut(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(rank_path, pattern)
        whole, marks = added_tokens(tokenizer_path) if tokenizer_path else (None, [])
        for part in lean(parts):
            rows, counts = [], [0]
            for text in part.to_pylist():
                if any(mark in text for mark in marks):
                    data = np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes() + end
                else:
                    data = own.encode(text) + end
                total = len(data) // 4
                first = total % capacity or capacity
                edges = [0, *range(first, total + 1, capacity)] if total > capacity else [0, total]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    piece = data[4 * a : 4 * b]
                    row = (k, a, b - a, zlib.crc32(piece))
                    rows.append((*row, kept(piece)) if keep_ids else row)
                counts.append(len(rows))
            columns = zip(*rows) if rows else ((),) * len(fields)
            arrays = [pa.array(c, t) for c, (_, t) in zip(columns, fields)]
            inner = pa.StructArray.from_arrays(arrays, names=[n for n, _ in fields])
            yield pa.ListArray.from_arrays(pa.array(counts, pa.int32()), inner)

    rows = id_and_text(docs, id_col, text_col).select("id", F.explode(cut("text")).alias("p"))
    return rows.select(F.col("id").alias(id_col), "p.*")


def pack_ids(piece: bytes) -> bytes:
    """Ids of four bytes each as compressed bytes: of two bytes where all ids fit, of four otherwise."""
    ids = np.frombuffer(piece, "<u4")
    short = ids.astype("<u2") if ids.max(initial=0) < 1 << 16 else ids
    return short.itemsize.to_bytes(1, "little") + pa.compress(short.tobytes(), "zstd", asbytes=True)


def unpacked_ids(packed: Column, length: Column) -> Column:
    """The ids of a piece (array of int) from what ``pack_ids`` made of them and their number."""

    @F.arrow_udf("array<int>")
    def unpacked(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for data, lengths in lean(parts):
            made = [
                np.frombuffer(pa.decompress(own[1:], own[0] * n, "zstd"), f"<u{own[0]}").astype(np.int32)
                for own, n in zip(data.to_pylist(), lengths.to_pylist())
            ]
            counts = np.concatenate([[0], np.cumsum([len(ids) for ids in made])]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(counts), pa.array(np.concatenate(made) if made else [], pa.int32()))

    return unpacked(packed, length)


class Packing:
    """Bins and how full each is; the tightest open one for a length is found by one bit operation."""

    def __init__(self, bins: Bins, fills: list[int], capacity: int) -> None:
        self.bins, self.fills, self.capacity = bins, fills, capacity

    def best_fit(self, items: list[int], lengths: list[int]) -> None:
        """Put each item, longest first, into the bin it fills best, or a new one."""
        bins, fills, capacity = self.bins, self.fills, self.capacity
        open_: list[list[int]] = [[] for _ in range(capacity + 1)]
        mask = 0
        for number, fill in enumerate(fills):
            if fill < capacity:
                open_[capacity - fill].append(number)
                mask |= 1 << (capacity - fill)
        for item in sorted(items, key=lengths.__getitem__, reverse=True):
            length = lengths[item]
            fitting = mask >> length
            if fitting:
                space = length + (fitting & -fitting).bit_length() - 1
                number = open_[space].pop()
                if not open_[space]:
                    mask ^= 1 << space
                bins[number].append(item)
                fills[number] += length
            else:
                space, number = capacity, len(bins)
                bins.append([item])
                fills.append(length)
            if space > length:
                open_[space - length].append(number)
                mask |= 1 << (space - length)

    def cost(self) -> tuple[int, int]:
        """Fewer bins first; among equals, the one that fills some bins well and leaves others open."""
        return len(self.bins), -sum(fill * fill for fill in self.fills)


def packing_of(bins: Bins, lengths: list[int], capacity: int) -> Packing:
    return Packing(bins, [sum(lengths[i] for i in own) for own in bins], capacity)


def crossover(one: Packing, other: Packing, lengths: list[int], rng: np.random.Generator) -> Packing:
    """Inject well-filled bins of ``other`` into ``one`` whole.

    Bins of ``one`` that share a document with an injected bin are dissolved, and so are some of its
    least filled ones; their other documents are displaced and placed by best fit.
    """
    fill = np.array(other.fills)
    good = np.flatnonzero(fill >= np.median(fill))
    chosen = good[rng.random(len(good)) < rng.uniform(0.1, 0.5)].tolist()
    taken = {i for number in chosen for i in other.bins[number]}
    kept, displaced = [], []
    for number, own in enumerate(one.bins):
        if taken.isdisjoint(own):
            kept.append(number)
        else:
            displaced += [i for i in own if i not in taken]
    kept.sort(key=one.fills.__getitem__)
    loose = int(rng.integers(2, 7))
    displaced += [i for number in kept[:loose] for i in one.bins[number]]
    bins = [list(one.bins[k]) for k in kept[loose:]] + [list(other.bins[k]) for k in chosen]
    child = Packing(bins, [one.fills[k] for k in kept[loose:]] + [other.fills[k] for k in chosen], one.capacity)
    child.best_fit(displaced, lengths)
    return child


def first_members(lengths: list[int], capacity: int, size: int, rng: np.random.Generator) -> list[Packing]:
    """A best-fit-decreasing packing, and others that start from random bins."""
    members = []
    for k in range(size):
        order = rng.permutation(len(lengths)).tolist()
        early = order[: k * len(order) // (4 * size)]
        bins, fills = [], []
        for item in early:  # first into the last bin, as they come
            if fills and fills[-1] + lengths[item] <= capacity:
                bins[-1].append(item)
                fills[-1] += lengths[item]
            else:
                bins.append([item])
                fills.append(lengths[item])
        member = Packing(bins, fills, capacity)
        member.best_fit(order[len(early) :], lengths)
        members.append(member)
    return members


def evolve(members: list[Packing], lengths: list[int], capacity: int, generations: int, rng: np.random.Generator) -> list[Packing]:
    """Steady-state evolution: each child replaces the worst member if it is better.

    It ends early at the lower bound, the total length over the capacity.
    """
    bound = -(-sum(lengths) // capacity)
    ranked = sorted(((m.cost(), k, m) for k, m in enumerate(members)), key=lambda x: x[:2])
    for step in range(generations):
        if ranked[0][0][0] <= bound or len(ranked) < 2:
            break
        a, b = rng.choice(len(ranked), 2, replace=False)
        child = crossover(ranked[min(a, b)][2], ranked[max(a, b)][2], lengths, rng)
        value = child.cost()
        if value < ranked[-1][0]:
            ranked[-1] = (value, len(members) + step, child)
            ranked.sort(key=lambda x: x[:2])
    return [m for _, _, m in ranked]


def pack_pieces(
    pieces: DataFrame,
    capacity: int = 1024,
    block_items: int = 8192,
    islands: int = 2,
    population: int = 4,
    generations: int = 12,
    epochs: int = 2,
) -> DataFrame:
    """All rows of ``pieces`` with ``sequence_id`` and ``offset`` (long): where each piece lies.

    ``pieces`` has a unique ``uid`` (long) and a ``length`` of 1 to ``capacity`` per row. Full pieces
    are sequences of their own. The others are dealt by the hash of ``uid`` into blocks of about
    ``block_items``; every block is packed by several islands, each a population of packings of its
    own, and after every epoch the best packing of an island moves on to the next one. The best
    packing of a block's islands counts. A block costs at most one sequence more than packing all
    pieces at once would; only numbers, no tokens, are dealt.
    """
    full = F.col("length") >= capacity
    count = pieces.where(~full).count()
    blocks = max(1, -(-count // block_items))
    tasks = min(blocks * islands, 10_000)
    items = pieces.where(~full).select("uid", F.col("length").cast("int").alias("length"))
    items = items.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)))
    state = "block long, island int, uids array<long>, lengths array<int>, members array<array<int>>"

    def numbered(bins: Bins, n: int) -> np.ndarray:
        where = np.empty(n, np.int32)
        for number, own in enumerate(bins):
            where[own] = number
        return where

    def bins_of(where: np.ndarray) -> Bins:
        order = np.argsort(where, kind="stable")
        cuts = np.flatnonzero(np.diff(where[order])) + 1
        return [own.tolist() for own in np.split(order, cuts)]

    def begin(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "uid"], ascending=[False, True])
        lengths, block = part["length"].tolist(), int(part["block"].iloc[0])
        rows = []
        for island in range(islands):
            rng = np.random.default_rng([block, island])
            members = first_members(lengths, capacity, population, rng)
            rows.append((block, island, part["uid"].to_numpy(), lengths, [numbered(m.bins, len(lengths)) for m in members]))
        return pd.DataFrame(rows, columns=["block", "island", "uids", "lengths", "members"])

    def epoch(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        lengths = part["lengths"].iloc[0].tolist()
        members = [packing_of(bins_of(np.asarray(m)), lengths, capacity) for own in part["members"] for m in own]
        rng = np.random.default_rng([key[0], key[1], len(members)])
        members = evolve(members, lengths, capacity, generations, rng)
        packed = [numbered(m.bins, len(lengths)) for m in members[:population]]
        common = (part["uids"].iloc[0], lengths)
        rows = [(key[0], key[1], *common, packed), (key[0], (key[1] + 1) % islands, *common, packed[:1])]
        return pd.DataFrame(rows, columns=["block", "island", "uids", "lengths", "members"])

    def best(part: pd.DataFrame) -> pd.DataFrame:
        lengths = part["lengths"].iloc[0].tolist()
        options = [packing_of(bins_of(np.asarray(m)), lengths, capacity) for own in part["members"] for m in own]
        bins = min(options, key=Packing.cost).bins
        uids, block = part["uids"].iloc[0], int(part["block"].iloc[0])
        rows = []
        for number, own in enumerate(bins):
            at = 0
            for item in own:
                rows.append((uids[item], (block << 32) + number, at))
                at += lengths[item]
        return pd.DataFrame(rows, columns=["uid", "sequence_id", "offset"])

    rows = items.repartition(min(blocks, 10_000), "block").groupBy("block").applyInPandas(begin, state)
    for _ in range(epochs):
        rows = rows.repartition(tasks, "block", "island").groupBy("block", "island").applyInPandas(epoch, state)
    placed = rows.repartition(min(blocks, 10_000), "block").groupBy("block").applyInPandas(best, "uid long, sequence_id long, offset long")
    alone = pieces.where(full).select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return pieces.join(placed.union(alone), "uid")


def pack_documents(
    docs: DataFrame, rank_path: str, pattern: str, end_id: int = 2, capacity: int = 1024,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, tokenizer_path: str | None = None,
) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every document.

    Pieces of repeated rows are told apart by a row number given when the pieces are written, so
    each is packed. An empty table gives no rows; other columns are ignored. Ids that are kept are written and
    shuffled in compressed form.
    """
    pieces = document_pieces(docs, rank_path, pattern, end_id, capacity, id_col, text_col, keep_ids, tokenizer_path, packed=keep_ids)
    pieces = materialise(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    placed = pack_pieces(pieces, capacity).drop("uid")
    return placed.withColumn("ids", unpacked_ids("ids", "length")) if keep_ids else placed
