"""N-gram Jaccard join: sets of word shingles that overlap, and the components they form."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import id_and_text, lean, release
from corpusloom.llm.components import components
from corpusloom.llm.quality import windows
from corpusloom.session import materialise

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
MIX = np.uint64(0xD6E8FEB86659FD93)
#: Rows with their sketches that a task compares at once.
BUCKET_BYTES = 8 << 20


#: Which bytes belong to words: all but ASCII white space.
IN_WORD = np.array([bytes([b]).strip() != b"" for b in range(256)])
#: The bytes that a word of 0 to 8 bytes has in a little-endian number.
OWN_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Words of more bytes are hashed one by one.
LONG_WORD = 32
#: Bytes of texts that are hashed at once; a longer text is hashed alone.
PIECE_BYTES = 1 << 20


def mixed(codes: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers in which every bit depends on every bit."""
    codes = (codes ^ (codes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    codes = (codes ^ (codes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return codes ^ (codes >> np.uint64(31))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every run without ASCII white space, all words at once in blocks of 8 bytes."""
    data = b"\n" + data + b"\n" * 8
    inside = IN_WORD[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    blocks = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    codes = mixed((blocks[starts] & OWN_BYTES[np.minimum(sizes, 8)]) ^ (sizes.astype(np.uint64) * MIX))
    for done in range(8, LONG_WORD, 8):
        at = np.flatnonzero((sizes > done) & (sizes <= LONG_WORD))
        block = blocks[starts[at] + done] & OWN_BYTES[np.minimum(sizes[at] - done, 8)]
        codes[at] = mixed(codes[at] * MIX + block)
    for k in np.flatnonzero(sizes > LONG_WORD).tolist():
        codes[k] = xxhash.xxh64_intdigest(data[starts[k] : starts[k] + sizes[k]])
    return starts - 1, codes


def text_shingles(texts: Iterable[str], words_each: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes.

    A-Z is lower-cased; words are runs without ASCII white space. A text with fewer words than a
    shingle has its whole sequence as one, a text without words none. Texts are hashed in pieces.
    """

    def hashed(piece: list[bytes]) -> Iterator[np.ndarray]:
        starts, codes = word_hashes(b"\n".join(piece).translate(LOWER))
        ends = np.searchsorted(starts, np.cumsum([len(data) + 1 for data in piece])).tolist()
        runs = windows(codes, words_each) if len(codes) >= words_each else codes[:0]
        first = 0
        for end in ends:
            n = end - first
            own = np.sort(runs[first : end - words_each + 1] if n >= words_each else windows(codes[first:end], n) if n else codes[:0])
            yield own[np.append(True, own[1:] != own[:-1])] if len(own) else own
            first = end

    piece, size = [], 0
    for text in texts:
        data = text.encode("utf-8", "replace")
        if piece and size + len(data) > PIECE_BYTES:
            yield from hashed(piece)
            piece, size = [], 0
        piece.append(data)
        size += len(data)
    if piece:
        yield from hashed(piece)


def shingles(text: str, words_each: int) -> np.ndarray:
    """:func:`text_shingles` of one text."""
    return next(text_shingles([text], words_each))


class Threshold:
    """Jaccard similarity of at least ``percent`` / 100, in whole numbers."""

    def __init__(self, percent: int) -> None:
        self.percent = percent

    def least(self, size: int) -> int:
        """The smallest overlap, and the smallest partner, of a set of ``size``."""
        return -(-size * self.percent // 100)

    def prefix(self, size: int) -> int:
        return size - self.least(size) + 1

    def apart(self, size: int, other: np.ndarray) -> np.ndarray:
        """The most elements that a linked pair of these sizes has in one set only."""
        both = size + other
        return both - 2 * -(-both * self.percent // (100 + self.percent))

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        common = len(np.intersect1d(a, b, assume_unique=True))
        return common > 0 and 100 * common >= self.percent * (len(a) + len(b) - common)

    def subset_sizes(self, size: int) -> list[int]:
        """The overlaps that a set must share with each possible larger partner."""
        return sorted({self.least(n) for n in range(size, 100 * size // self.percent + 1)})

    def subsets(self, size: int) -> int:
        return sum(math.comb(size, k) for k in self.subset_sizes(size))


def subset_keys(codes: np.ndarray, threshold: Threshold) -> np.ndarray:
    """One key per subset of the sizes that partners must share, by taking elements away from the sum."""
    spread = (codes ^ (codes >> np.uint64(31))) * MIX
    total, keys = spread.sum(), []
    for size in threshold.subset_sizes(len(codes)):
        gone = len(codes) - size
        picks = np.array(list(itertools.combinations(range(len(codes)), gone)), np.int64).reshape(math.comb(len(codes), gone), gone)
        keys.append(total - spread[picks].sum(1, dtype=np.uint64) + np.array([size], np.uint64) * MIX)
    return np.concatenate(keys)


def parity_sketch(codes: np.ndarray, threshold: Threshold) -> bytes:
    """A bit per hash value, flipped by every element: two sketches differ in no more bits than the sets in elements."""
    size = len(codes)
    most = int(threshold.apart(size, np.array([100 * size // threshold.percent]))[0])
    bits = 1 << max(8, (8 * most - 1).bit_length())
    slots = ((codes * MIX) >> np.uint64(32)).astype(np.int64) & (bits - 1)
    odd = np.bincount(slots, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def fingerprint(codes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(codes.tobytes())


def signatures(codes: np.ndarray, threshold: Threshold, common: np.ndarray, small: int) -> tuple[np.ndarray, bytes]:
    """The keys under which a set meets its partners, and its parity sketch.

    Sets of at most ``small`` elements give their subsets; larger ones, and small ones that a larger one may
    link with, the elements of their prefix in the order "common ones last, then by hash".
    """
    if not len(codes):
        return codes, b""
    keys = [subset_keys(codes, threshold)] if len(codes) <= small else []
    if len(codes) >= threshold.least(small + 1):
        often = common[np.minimum(np.searchsorted(common, codes), len(common) - 1)] == codes if len(common) else np.zeros(len(codes), bool)
        keys.append(np.concatenate([codes[~often], codes[often]])[: threshold.prefix(len(codes))])
    return np.unique(np.concatenate(keys)), parity_sketch(codes, threshold)


def folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches brought to ``size`` bytes, as rows of 64-bit words."""
    rows = np.empty((len(sketches), size // 8), np.uint64)
    for i, sketch in enumerate(sketches):
        rows[i] = np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, size // 8), 0)
    return rows


class Sketches:
    """Sketches of rows, compared at the width of the smaller set."""

    def __init__(self, sketches: list[bytes]) -> None:
        self.widths = np.array([len(s) for s in sketches])
        self.rows, self.place = {}, {}
        for width in np.unique(self.widths).tolist():
            at = np.flatnonzero((self.widths == width) | (self.widths == 2 * width))
            self.place[width] = np.zeros(len(sketches), np.int64)
            self.place[width][at] = np.arange(len(at))
            self.rows[width] = folded([sketches[i] for i in at], width)

    def differ(self, small: np.ndarray, large: np.ndarray) -> np.ndarray:
        """In how many bits the sketches of each pair differ."""
        result = np.empty(len(small), np.int64)
        for width in np.unique(self.widths[small]).tolist():
            rows, place = self.rows[width], self.place[width]
            every = np.flatnonzero(self.widths[small] == width)
            for at in np.array_split(every, 1 + len(every) * width // 8_000_000):
                result[at] = np.bitwise_count(rows[place[small[at]]] ^ rows[place[large[at]]]).sum(1)
        return result


def possible_pairs(part: pd.DataFrame, lists: np.ndarray, threshold: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one list and different components that sizes and sketches do not rule out.

    Rows are ordered by list and size, so the partners of a row follow it; they are paired in pieces.
    """
    sizes, comps = part["n"].to_numpy(), pd.factorize(part["component"])[0]
    sides, sketches = part["side"].to_numpy(), Sketches(part["sketch"].tolist())
    scale = int(sizes.max()) + 1
    reach = np.searchsorted(lists * scale + sizes, lists * scale + np.minimum(100 * sizes // threshold.percent, scale - 1), side="right")
    counts = reach - np.arange(len(part)) - 1
    total = np.cumsum(counts)
    found, start = [(np.empty(0, np.int64), np.empty(0, np.int64))], 0
    while start < len(part):
        stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + 250_000)))
        own = counts[start:stop]
        small = np.repeat(np.arange(start, min(stop, len(part))), own)
        large = small + 1 + np.arange(len(small)) - np.repeat(np.cumsum(own) - own, own)
        good = (comps[small] != comps[large]) & ((sides[small] != sides[large]) | (sides[small] < 0))
        small, large = small[good], large[good]
        good = sketches.differ(small, large) <= threshold.apart(sizes[small], sizes[large])
        found.append((small[good], large[good]))
        start = stop
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def star_forest(small: np.ndarray, large: np.ndarray) -> list[int]:
    """Some of the pairs, fewer than there are rows: from the rows with most partners to rows not yet reached."""
    near: dict[int, list[tuple[int, int]]] = {}
    for k, (a, b) in enumerate(zip(small.tolist(), large.tolist())):
        near.setdefault(a, []).append((b, k))
        near.setdefault(b, []).append((a, k))
    reached, chosen = set(), []
    for row in sorted(near, key=lambda x: -len(near[x])):
        fresh = [(other, k) for other, k in near[row] if other not in reached]
        if fresh:
            chosen += [k for _, k in fresh]
            reached.update(other for other, _ in fresh)
            reached.add(row)
    return chosen


def chosen_pairs(part: pd.DataFrame, threshold: Threshold, every: bool) -> pd.DataFrame:
    """Pairs to verify of many lists: all possible ones, or a star forest where they are many (``whole`` is false then)."""
    part = part.sort_values(["key", "i", "j", "n", "id"], ignore_index=True)
    names = part[["key", "i", "j"]].to_numpy()
    lists = np.cumsum(np.append(False, (names[1:] != names[:-1]).any(1)))
    small, large = possible_pairs(part, lists, threshold)
    rows, pairs = np.bincount(lists), np.bincount(lists[small], minlength=int(lists[-1]) + 1)
    whole = np.ones(len(small), bool)
    if not every and (pairs > 4 * rows).any():
        many = pairs > 4 * rows
        keep = ~many[lists[small]]
        for number in np.flatnonzero(many):
            at = np.flatnonzero(lists[small] == number)
            picked = at[star_forest(small[at], large[at])]
            keep[picked], whole[picked] = True, False
        small, large, whole = small[keep], large[keep], whole[keep]
    ids = part["id"].to_numpy()
    a, b = ids[small], ids[large]
    return pd.DataFrame({"a": np.where(a < b, a, b), "b": np.where(a < b, b, a), "whole": whole})


def distinct_lists(lists: DataFrame) -> DataFrame:
    """One list of each set of members, that of the smallest key: ``key, id, print, head, rows`` without ``print``.

    Near copies share most elements of their prefixes, and so as many lists with the same rows, which would all give the same pairs.
    Sets of members are told apart by their size, their smallest id and two 64-bit hashes.
    """
    marks = [F.xxhash64(F.lit(seed), "id", "print").alias(f"mark{seed}") for seed in (1, 2)]
    members = lists.select("key", "head", "rows", *marks).groupBy("key", "head", "rows").agg(*[F.bit_xor(f"mark{seed}").alias(f"mark{seed}") for seed in (1, 2)])
    kept = members.groupBy("head", "rows", "mark1", "mark2").agg(F.min("key").alias("key")).select("key")
    return lists.drop("print").join(kept, "key")


class JaccardJoin:
    """The steps of :func:`jaccard_components`, with what they share."""

    def __init__(self, docs: DataFrame, words_each: int, percent: int, id_col: str, text_col: str, list_rows: int) -> None:
        self.rows = id_and_text(docs, id_col, text_col)
        self.words, self.threshold, self.list_rows = words_each, Threshold(percent), list_rows
        self.kind = dict(self.rows.dtypes)["id"]

    def sets(self) -> DataFrame:
        """``id, n, print, prefix``: size, 128-bit fingerprint and hash-ordered prefix of each row's set."""
        words, threshold = self.words, self.threshold

        @F.pandas_udf("struct<n long, print binary, prefix array<long>>")
        def summary(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for part in lean(parts):
                rows = []
                for codes in text_shingles(part, words):
                    first = codes[: threshold.prefix(len(codes))] if len(codes) else codes
                    rows.append((len(codes), fingerprint(codes), first.view(np.int64)))
                yield pd.DataFrame(rows, columns=["n", "print", "prefix"])

        return materialise(self.rows.select("id", summary("text").alias("s")).select("id", "s.*"), "shingle-sets")

    def plan(self, firsts: DataFrame) -> tuple[np.ndarray, int]:
        """The common elements, at most 100,000 whatever the size of the corpus, and the boundary of small sets.

        The boundary is where enumerating subsets of a size begins to cost more than scanning the
        inverted lists of its prefix, for the measured sizes and lists.
        """
        lists = materialise(
            firsts.select(F.explode("prefix").alias("key")).groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "lists"
        )
        total = firsts.agg(F.sum(F.size("prefix"))).first()[0] or 0
        often = max(64, -(-total // 100_000))
        common = [r["key"] for r in lists.where(F.col("c") >= often).select("key").collect()]
        excess = lists.where(F.col("c") < often).agg(F.sum(F.col("c") * (F.col("c") - 1))).first()[0] or 0
        scan = 1 + excess / max(total, 1)
        sizes = {r["n"]: r["c"] for r in firsts.where("n <= 64").groupBy("n").agg(F.count("*").alias("c")).collect()}
        best, small, saved = 0.0, 0, 0.0
        for n in range(1, 65):
            saved += sizes.get(n, 0) * (self.threshold.prefix(n) * scan - self.threshold.subsets(n))
            if saved > best:
                best, small = saved, n
        return np.sort(np.array(common, np.int64).view(np.uint64)), small

    def keyed(self, firsts: DataFrame, common: np.ndarray, small: int) -> DataFrame:
        """``id, n, sketch, keys`` of one row per distinct set."""
        words, threshold = self.words, self.threshold
        held = self.rows.sparkSession.sparkContext.broadcast(common)

        @F.pandas_udf("struct<keys array<long>, sketch binary, print binary>")
        def sign(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for part in lean(parts):
                sets = text_shingles(part, words)
                rows = [(*signatures(codes, threshold, held.value, small), fingerprint(codes)) for codes in sets]
                yield pd.DataFrame([(k.view(np.int64), s, p) for k, s, p in rows], columns=["keys", "sketch", "print"])

        signed = self.rows.select("id", sign("text").alias("s")).select("id", "s.*")
        return materialise(signed.join(firsts.select("id", "print", "n"), ["id", "print"]).dropDuplicates(["id", "print"]), "signatures")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """``a, b, linked``: every pair decided on the whole sets of both texts."""
        words, threshold = self.words, self.threshold

        @F.pandas_udf("boolean")
        def linked(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for left, right in lean(parts):
                known: dict[str, np.ndarray] = {}
                result = []
                for x, codes in zip(left, text_shingles(right, words)):
                    if x not in known:
                        known = {x: shingles(x, words)}
                    result.append(threshold.linked(known[x], codes))
                yield pd.Series(result, dtype=bool)

        right = pairs.join(self.rows, pairs["b"] == self.rows["id"]).select("a", "b", F.col("text").alias("right"))
        both = right.join(self.rows, right["a"] == self.rows["id"])
        return materialise(both.select("a", "b", linked("text", "right").alias("linked")), "verified")

    def stars(self, lists: DataFrame, keyed: DataFrame) -> DataFrame:
        """In lists of more than ``list_rows`` rows, the pairs with the smallest id that nothing rules out."""
        threshold = self.threshold

        @F.pandas_udf("boolean")
        def possible(n: pd.Series, sketch: pd.Series, m: pd.Series, other: pd.Series) -> pd.Series:
            first, second = n.to_numpy(), m.to_numpy()
            fits = np.maximum(first, second) * threshold.percent <= 100 * np.minimum(first, second)
            at = np.flatnonzero(fits)
            both = Sketches([*sketch.iloc[at], *other.iloc[at]])
            left, right = np.arange(len(at)), np.arange(len(at), 2 * len(at))
            less = first[at] <= second[at]
            differ = both.differ(np.where(less, left, right), np.where(less, right, left))
            fits[at] = differ <= threshold.apart(first[at], second[at])
            return pd.Series(fits)

        own = keyed.select(F.col("id").alias("b"), "n", "sketch")
        head = keyed.select(F.col("id").alias("a"), F.col("n").alias("m"), F.col("sketch").alias("other"))
        pairs = lists.where((F.col("rows") > self.list_rows) & (F.col("id") != F.col("head")))
        pairs = pairs.select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
        return pairs.join(own, "b").join(head, "a").where(possible("n", "sketch", "m", "other")).select("a", "b")

    def undecided(self, lists: DataFrame, keyed: DataFrame, found: DataFrame | None, every: bool) -> DataFrame:
        """Pairs of different components that share a list and that nothing rules out; ``whole`` is false for pairs that stand for more."""
        rows = lists.withColumn("component", F.col("id"))
        if found is not None:
            comps = found.select(F.col("node").alias("id"), F.col("component").alias("joined"))
            rows = lists.join(comps, "id", "left").withColumn("component", F.coalesce("joined", "id")).drop("joined")
            rows = materialise(rows, "listed")
            mixed = rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
            rows = rows.join(materialise(mixed.select("key"), "mixed-lists"), "key")
        rows = rows.withColumn("parts", F.ceil(F.col("rows") / self.list_rows)).join(keyed.select("id", "n", "sketch"), "id")
        rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")))
        cells = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        cells = materialise(cells.select(
            "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "n", "sketch", "component",
            F.when(F.col("own") == F.col("other"), -1 - F.col("own")).otherwise(F.col("own")).alias("side"),
        ), "cells")
        size = cells.agg(F.sum(F.length("sketch") + 64)).first()[0] or 0
        buckets = max(12, -(-size // BUCKET_BYTES))
        threshold = self.threshold

        def choose(part: pd.DataFrame) -> pd.DataFrame:
            release()
            pairs = chosen_pairs(part, threshold, every)
            release()
            return pairs

        dealt = cells.withColumn("bucket", F.pmod(F.xxhash64("key", "i", "j"), F.lit(buckets)))
        dealt = dealt.repartition(min(buckets, 20_000), "bucket").groupBy("bucket")
        pairs = dealt.applyInPandas(choose, f"a {self.kind}, b {self.kind}, whole boolean")
        return materialise(pairs.groupBy("a", "b").agg(F.min("whole").alias("whole")), "undecided")


def jaccard_components(
    docs: DataFrame,
    words_each: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    list_rows: int = 4096,
) -> DataFrame:
    """``id_col, n_shingles, component_id`` for every row.

    Two rows link when their sets of shingles have a Jaccard similarity of at least ``percent`` / 100;
    a component is named by the smallest id in it. The join is size-aware: small sets enumerate the
    subsets that a partner must share, large sets meet in the inverted lists of a prefix, and the
    boundary between them is chosen by cost.

    Copies of one set are represented by their smallest id. Pairs of a list are ruled out by sizes and
    parity sketches, which never reject a linked pair; of lists with the same rows one is read. The others are verified on their whole sets, by
    64-bit hashes of the shingles. Where a list has many more possible pairs than rows, a star forest
    of them is verified first, and only pairs of components that are still different afterwards, until
    none is undecided. A list of more than ``list_rows`` rows is first verified against its smallest id, and what
    is still undecided is compared in cells of about ``2 * list_rows`` rows.

    - null and empty texts, and texts without words: no shingles, linked with nothing, a component of their own
    - null ids: linked with nothing, with a null component
    - rows that share an id are one node; each is returned
    - an empty table gives an empty result; other columns are ignored
    """
    join = JaccardJoin(docs, words_each, percent, id_col, text_col, list_rows)
    sets = join.sets()
    groups = materialise(sets.where("n > 0 AND id IS NOT NULL").groupBy("print").agg(F.min("id").alias("first")), "same-sets")
    firsts = sets.join(groups, (sets["id"] == groups["first"]) & (sets["print"] == groups["print"])).select("id", "n", sets["print"], "prefix")
    firsts = materialise(firsts.dropDuplicates(["id", "print"]), "distinct-sets")
    keyed = join.keyed(firsts, *join.plan(firsts))
    listed = keyed.select("id", "n", "print", F.explode("keys").alias("key"))
    least, most = F.min("n"), F.max("n")
    heads = listed.groupBy("key").agg(F.min("id").alias("head"), F.count("*").alias("rows"), least.alias("x"), most.alias("y"))
    heads = materialise(heads.where((F.col("rows") > 2) | (F.col("rows") == 2) & (100 * F.col("x") >= percent * F.col("y"))), "heads")
    lists = materialise(listed.join(heads.drop("x", "y"), "key").drop("n"), "long-lists")
    lists = materialise(distinct_lists(lists), "distinct-lists")
    tried, found = None, None
    if not lists.where(F.col("rows") > list_rows).isEmpty():
        tried = join.verified(materialise(join.stars(lists, keyed), "pairs"))
        found = components(tried.where("linked"))
    lists = lists.drop("head")
    for every in (False, False, False, True):
        pairs = join.undecided(lists, keyed, found, every)
        done = every or pairs.where("NOT whole").isEmpty()
        pairs = pairs.select("a", "b")
        checked = join.verified(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        tried = checked if tried is None else tried.unionByName(checked)
        found = components(tried.where("linked"))
        if done:
            break
    rows = sets.select("id", "n", "print").join(groups, "print", "left")
    rows = rows.join(found.withColumnRenamed("node", "first"), "first", "left")
    own = F.when(F.col("n") > 0, F.coalesce("component", "first")).otherwise(F.col("id"))
    return rows.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), own).alias("component_id"),
    )
