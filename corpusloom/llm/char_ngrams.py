"""Hashed character n-grams of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BITS = 20
STEP = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xD6E8FEB86659FD93)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased code points of all texts in one array, and where each text ends in it."""
    raw = [t.lower().encode("utf-32-le", "replace") for t in texts]
    ends = np.cumsum([len(x) // 4 for x in raw], dtype=np.int64)
    return np.frombuffer(b"".join(raw), "<u4").astype(np.uint64), ends


def ngrams(points: np.ndarray, ends: np.ndarray, lengths: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length the buckets at all positions, and whether the n-gram lies in one text."""
    owner = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(ends, prepend=0))
    mixed = points + np.uint64(1)
    for n in range(1, max(lengths) + 1):
        if n > 1:
            mixed = mixed[:-1] * STEP + points[n - 1 :] if len(mixed) > 0 else mixed
        if n in lengths and len(mixed):
            yield ((mixed * SPREAD) >> np.uint64(64 - BITS)).astype(np.int32), owner[n - 1 :] == owner[: len(mixed)]


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in ascending order, by sorting in place; the hash table of ``np.unique`` takes more memory and time."""
    values.sort()
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def present(texts: list[str], lengths: tuple[int, ...], wanted: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The distinct (text, bucket) pairs of the wanted buckets, as pairs of arrays ordered by text.

    Texts are taken a quarter of a million characters at a time, one pair of arrays each, so memory does not
    follow the size of the batch.
    """
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size < 250_000):
            size += len(texts[stop])
            stop += 1
        points, ends = code_points(texts[start:stop])
        owner = np.repeat(np.arange(start, stop, dtype=np.int64), np.diff(ends, prepend=0))
        found = [np.empty(0, np.int64)]
        for buckets, inside in ngrams(points, ends, lengths):
            at = np.flatnonzero(inside if wanted is None else wanted[buckets] & inside)
            found.append(distinct((owner[at] << BITS) | buckets[at]))
        pairs = distinct(np.concatenate(found))
        yield pairs >> BITS, pairs & (2**BITS - 1)
        start = stop
