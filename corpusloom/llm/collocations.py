"""Phrase collocations from depth-truncated suffix subtrees, partitioned by word prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as w

from corpusloom.llm.common import lean, named, small_batches
from corpusloom.session import materialise

UPPER, STOPS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:!?\x0a\x0b\x0c\x0d"
#: A-Z in lower case, a tab as a blank, and every byte that ends a piece as a full stop.
FOLD = bytes.maketrans(UPPER + STOPS + b"\t", UPPER.lower() + b"." * len(STOPS) + b" ")
CHUNK = 16 << 20
SLICE = 100_000
SALTS = 256
#: Words and pairs are first counted in so many slots by hash.
SLOT_BITS = 27
MIX = np.uint64(0x9E3779B97F4A7C15)


def word_names(depth: int) -> list[str]:
    return [f"w{i}" for i in range(depth)]


def coded_words(folded: bytes) -> tuple[np.ndarray, pa.Array]:
    """The words in order, 0 at the end of a piece and from 1 on an index into the dictionary."""
    spaced = folded.replace(b".", b" . ")
    tokens = pc.split_pattern(pa.array([spaced], pa.large_binary()), pattern=b" ").values
    coded = tokens.filter(pc.not_equal(tokens, pa.scalar(b"", pa.large_binary()))).dictionary_encode()
    ends = pc.index(coded.dictionary, pa.scalar(b".", pa.large_binary())).as_py()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    codes[codes == ends + 1] = 0
    return codes, coded.dictionary


def word_hashes(words: pa.Array, lang: str) -> np.ndarray:
    """A hash for each word of a language; the first place is for the end of a piece."""
    seed = xxhash.xxh64_intdigest(lang.encode()) & 0x7FFFFFFF
    return np.array([0, *(xxhash.xxh64_intdigest(x, seed) for x in words.to_pylist())], np.uint64)


def slots(first: np.ndarray, second: np.ndarray | int = 0) -> np.ndarray:
    """The slot of a word, or of a pair, from their hashes."""
    x = (first ^ (first >> np.uint64(29))) * MIX + np.asarray(second, np.uint64)
    x = (x ^ (x >> np.uint64(32))) * MIX
    return (x >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def distinct_rows(columns: list[np.ndarray], base: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of columns of codes below ``base``, with their counts."""
    kinds, key = 1, np.zeros(len(columns[0]), np.int64)
    for column in columns:
        if kinds > (1 << 62) // base:
            held, key = np.unique(key, return_inverse=True)
            kinds = len(held)
        kinds, key = kinds * base, key * base + column
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return [column[first] for column in columns], counts


def truncated_suffixes(codes: np.ndarray, hashes: np.ndarray, frequent, depth: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct suffixes of the pieces, cut after ``depth`` words, as columns of codes with their counts.

    A suffix has 0 from where its piece ends, or from the second word of a pair in a slot that is not
    ``frequent``; no phrase with enough occurrences holds such a pair, or begins with such a word.
    """
    padded = np.concatenate([codes, np.zeros(depth, np.int64)])
    starts = np.flatnonzero(codes)
    starts = starts[frequent(slots(hashes))[codes[starts]]]
    columns, alive = [codes[starts]], np.ones(len(starts), bool)
    for k in range(1, depth):
        following = padded[starts + k]
        alive &= following > 0
        alive[alive] = frequent(slots(hashes[columns[-1][alive]], hashes[following[alive]]))
        columns.append(np.where(alive, following, 0))
    return distinct_rows(columns, len(hashes) + 1)


def by_chunk(combined):
    """Documents (lang, text) to what ``combined`` makes of the folded texts of a language, about 16 MB at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, held = {}, 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
                folded = text.as_py().translate(FOLD)
                texts.setdefault(lang, []).append(folded)
                held += len(folded)
                if held > CHUNK:
                    for lang, parts in texts.items():
                        yield from combined(lang, *coded_words(b".".join([*parts, b""])))
                    texts, held = {}, 0
        for lang, parts in texts.items():
            yield from combined(lang, *coded_words(b".".join([*parts, b""])))

    return lambda batches: lean(run(batches))


def slot_counts(lang: str, codes: np.ndarray, words: pa.Array) -> Iterator[pa.RecordBatch]:
    """Slots of the words and pairs of a chunk (slot, n)."""
    hashes = word_hashes(words, lang)
    counts = np.bincount(codes, minlength=len(hashes))[1:]
    inside = (codes[:-1] > 0) & (codes[1:] > 0)
    (first, second), n = distinct_rows([codes[:-1][inside], codes[1:][inside]], len(hashes) + 1)
    found = np.concatenate([slots(hashes[1:])[counts > 0], slots(hashes[first], hashes[second])])
    n = np.concatenate([counts[counts > 0], n])
    for at in range(0, len(n), SLICE):
        yield pa.RecordBatch.from_arrays([pa.array(found[at : at + SLICE]), pa.array(n[at : at + SLICE])], ["slot", "n"])


def suffix_rows(depth: int, frequent_bits):
    """The truncated suffixes of a chunk (lang, w0, w1, ..., c), and a row without words for the number of words."""
    schema = pa.schema([("lang", pa.string()), *[(name, pa.string()) for name in word_names(depth)], ("c", pa.int64())])

    def combined(lang: str, codes: np.ndarray, words: pa.Array) -> Iterator[pa.RecordBatch]:
        bits = frequent_bits.value
        frequent = lambda slot: (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
        columns, counts = truncated_suffixes(codes, word_hashes(words, lang), frequent, depth)
        columns = [np.append(c, 0) for c in columns]
        counts = np.append(counts, np.count_nonzero(codes))
        words = words.cast(pa.binary()).view(pa.string())
        for at in range(0, len(counts), SLICE):
            taken = [c[at : at + SLICE] for c in columns]
            part = [words.take(pa.array(c - 1, mask=c == 0)) for c in taken]
            own = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(taken[0]), np.int64)))
            yield pa.RecordBatch.from_arrays([own, *part, pa.array(counts[at : at + SLICE])], schema=schema)

    return combined


def frequent_slots(texts: DataFrame, min_count: int) -> np.ndarray:
    """A bit for each slot: whether its words and pairs have ``min_count`` occurrences together. 16 MB at any size of the corpus."""
    counted = texts.mapInArrow(by_chunk(slot_counts), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    place = F.col("slot") + 1  # the functions count from 1
    bitmaps = counted.where(F.col("n") >= min_count).groupBy(F.bitmap_bucket_number(place).alias("at")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    bits = np.zeros(1 << (SLOT_BITS - 3), np.uint8)
    for row in bitmaps.toLocalIterator():
        own = np.frombuffer(row["bits"], np.uint8)
        bits[(row["at"] - 1) * len(own) : row["at"] * len(own)] = own
    return bits


def subtrees(depth: int, min_count: int):
    """A group of suffixes to the nodes of its subtrees (lang, phrase, size, f) with ``min_count`` occurrences or more.

    Sorted suffixes hold a subtree as runs: a node is a run of suffixes that share its words, and
    its count the total of the leaves in the run. Nodes above the prefix by which the suffix was
    dealt are left out, for other groups hold the rest of them.
    """
    names = word_names(depth)
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("f", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        langs = table.column("lang").combine_chunks().dictionary_encode()
        columns = [table.column(name).combine_chunks() for name in names]
        coded = pa.concat_arrays(columns).dictionary_encode()
        words = coded.dictionary
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).reshape(depth, -1)
        path = [langs.indices.to_numpy(zero_copy_only=False), *codes]
        order = np.lexsort(path[::-1])
        path = [p[order] for p in path]
        counts = table.column("c").to_numpy()[order]
        own_depth = table.column("depth").to_numpy()[order]
        edge = np.ones(len(order), bool)
        edge[1:] = path[0][1:] != path[0][:-1]
        found, phrase = [], None
        for k in range(1, depth + 1):
            edge[1:] |= path[k][1:] != path[k][:-1]
            starts = np.flatnonzero(edge)
            total = np.add.reduceat(counts, starts)
            starts, total = starts[kept := (total >= min_count) & (path[k][starts] >= 0)], total[kept]
            starts, total = starts[kept := own_depth[starts] <= k], total[kept]
            parts = [words.take(pa.array(path[i][starts])) for i in range(1, k + 1)]
            phrase = pc.binary_join_element_wise(*parts, " ") if k > 1 else parts[0]
            lang = langs.dictionary.take(pa.array(path[0][starts]))
            found.append(pa.Table.from_arrays([lang, phrase, pa.array(np.full(len(starts), k, np.int32)), pa.array(total)], schema=schema))
        return pa.concat_tables(found)

    return run


def dealt(suffixes: DataFrame, depth: int, budget: int) -> tuple[DataFrame, list[DataFrame]]:
    """Suffixes with the group they belong to and the depth of the prefix that decides it; counts of the longer prefixes.

    A prefix is a word, or, while more than ``budget`` rows begin with it, a word longer. Prefixes
    are put together in groups of about half a budget. The prefixes that were extended are found by
    counting; there are at most a ``budget``-th as many as rows, and they are joined, not collected.
    """
    names = word_names(depth)
    rows, extended = suffixes.withColumn("depth", F.lit(1)), []
    for k in range(1, depth):
        keys = ["lang", *names[:k]]
        counted = rows.where(F.col("depth") == k).where(F.col(names[k - 1]).isNotNull())
        counted = counted.groupBy(*keys).agg(F.sum("c").alias("f"), F.count("*").alias("rows"))
        heavy = materialise(counted.where(F.col("rows") > budget).drop("rows"), "long-prefixes")
        extended.append(heavy.select("lang", F.concat_ws(" ", *names[:k]).alias("phrase"), F.lit(k).alias("size"), "f"))
        rows = rows.join(heavy.withColumn("longer", F.lit(1)).drop("f"), keys, "left")
        rows = rows.withColumn("depth", F.col("depth") + F.coalesce("longer", F.lit(0))).drop("longer")
    groups = max(1, -(-2 * suffixes.count() // budget))
    prefix = [F.when(F.col("depth") > i, F.col(name)) for i, name in enumerate(names)]
    group = F.pmod(F.xxhash64("lang", *prefix), F.lit(groups))
    return rows.withColumn("group", group), extended


def prefix_counts(docs: DataFrame, max_words: int, min_count: int, lang_col: str, text_col: str, budget: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of every phrase with ``min_count`` occurrences, and (lang, n), the words of every language."""
    small_batches(docs.sparkSession)
    lang = F.coalesce(named(lang_col).cast("string"), F.lit("und")).alias("lang")
    texts = docs.select(lang, F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"))
    bits = docs.sparkSession.sparkContext.broadcast(frequent_slots(texts, min_count))
    columns = ", ".join(f"{name} string" for name in word_names(max_words))
    suffixes = texts.mapInArrow(by_chunk(suffix_rows(max_words, bits)), f"lang string, {columns}, c long")
    suffixes = materialise(suffixes, "suffixes")
    totals = suffixes.where("w0 IS NULL").groupBy("lang").agg(F.sum("c").alias("n"))
    grouped, extended = dealt(suffixes.where("w0 IS NOT NULL"), max_words, budget)
    nodes = grouped.groupBy("group").applyInArrow(subtrees(max_words, min_count), "lang string, phrase string, size int, f long")
    for heavy in extended:
        nodes = nodes.unionByName(heavy.where(F.col("f") >= min_count))
    return materialise(nodes, "phrases"), totals


def exact_score(a: Column, left: Column, right: Column, scale: int) -> Column:
    """floor(scale * a * a / (left * right)) in whole numbers of up to 38 digits; counts have 15 at most."""
    wide = lambda c: c.cast("decimal(15,0)")
    top = wide(a) * wide(a) * F.lit(scale).cast("decimal(7,0)")
    return F.call_function("div", top, wide(left) * wide(right))


def collocations(
    docs: DataFrame,
    max_words: int = 3,
    min_count: int = 10,
    top: int = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
    inside_percent: int = 50,
    budget: int = 400_000,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the ``top`` phrases of every language.

    A-Z is lower-cased; ``.,;:!?`` and line ends cut a text into pieces, blanks and tabs a piece into
    words. Words and pairs are first counted in 2^27 slots by hash: a slot with fewer than ``min_count``
    holds no part of a candidate, so suffixes end before it. All suffixes of the pieces, cut after
    ``max_words`` words, are combined in each task and dealt to groups by their first words, where a prefix with more than ``budget`` rows is extended
    by the next word; each group builds its subtrees alone and reads the counts from leaf totals.
    So no group holds a frequent word whole, and a phrase of any frequency comes once from about
    16 MB of text. A group holds a few times ``budget`` rows at most, and for a frequent phrase of ``max_words`` one
    for each 16 MB of text.

    A phrase of 2 to ``max_words`` words with ``a >= min_count`` occurrences is a candidate. Cut after k
    words, its parts have ``l`` and ``r`` occurrences and it scores floor(1000000 a a / (l r)); the lowest
    cut counts, the first one among equals. A candidate inside a longer one that has ``inside_percent``
    of its occurrences or more is dropped. Phrases are ranked by score and count, falling, then by their bytes.

    - null text: empty; null language: ``und``; a row counts as often as it is there, ids play no part
    - ties: broken by the phrase, so ranks are unique in a language
    - texts without words and empty tables give no rows; other columns are ignored
    """
    if max_words < 2:
        raise ValueError("phrases have two words at least")
    nodes, totals = prefix_counts(docs, max_words, min_count, lang_col, text_col, budget)
    found = nodes.where(F.col("size") > 1)
    cut = found.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.withColumn("first", F.call_function("substring_index", F.col("phrase"), F.lit(" "), F.col("k")))
    cut = cut.withColumn("rest", F.substring(F.col("phrase"), F.length("first") + 2, F.length("phrase")))
    left = nodes.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = nodes.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cut = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = exact_score(F.col("a"), F.col("l"), F.col("r"), 1_000_000).alias("score")
    best = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score, "k", "l", "r")).alias("best"))
    kept = best
    if max_words > 2:
        parts = F.split("phrase", " ")
        spans = [(i, n) for n in range(2, max_words) for i in range(max_words - n + 1)]
        inner = F.array(*[F.when(F.col("size") >= max(n + 1, i + n), F.array_join(F.slice(parts, i + 1, n), " ")) for i, n in spans])
        longer = nodes.where(F.col("size") > 2).select("lang", "f", F.explode(F.array_compact(F.array_distinct(inner))).alias("phrase"))
        most = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
        kept = best.join(most, ["lang", "phrase"], "left").where(
            F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))
        )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = w.Window.partitionBy("lang", "salt").orderBy(*order)
    rows = rows.withColumn("salt", salt).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(w.Window.partitionBy("lang").orderBy(*order)).cast("long"))
    rows = rows.where(F.col("rank") <= top).join(totals, "lang")
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
