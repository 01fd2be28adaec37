"""Byte-level BPE through tiktoken, fast on long texts and on words that recur."""

from __future__ import annotations

import base64
import functools
import re
from array import array

import regex
import tiktoken
from tokenizers import Tokenizer

UNSAFE = re.compile(r"\s ")
LONG_RUN = 10_000
#: Positions that no match of the pattern spans: before white space that follows something else,
#: after a letter before a number or a punctuation mark, and after a number before a letter.
SAFE = regex.compile(r"(?<=\S)(?=[ \t\n\r])|(?<=\p{L})(?=[\p{N}\p{P}])|(?<=\p{N})(?=\p{L})")


@functools.lru_cache(maxsize=4)
def encoding(rank_path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a local rank file, without special tokens; read once per process."""
    with open(rank_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class WordCache(dict):
    """Blank plus word -> its ids as little-endian unsigned 32-bit integers, encoded when first met."""

    def __init__(self, encode, limit: int = 150_000) -> None:
        self.encode, self.limit = encode, limit

    def __missing__(self, word: str) -> bytes:
        packed = array("I", self.encode(" " + word)).tobytes()
        if len(word) <= 40:
            if len(self) >= self.limit:
                self.clear()
            self[word] = packed
        return packed


class Encoder:
    """Packed ids of whole texts, equal to encoding each text at once.

    No match of the pattern spans a blank that follows other than white space, so a text is cut at its
    blanks and each word is encoded with the blank before it, or looked up. A text with white space
    before a blank is cut at the positions of ``SAFE`` instead, into pieces of bounded length where
    it has such positions.
    """

    def __init__(self, rank_path: str, pattern: str) -> None:
        self.encoding = encoding(rank_path, pattern)
        self.words = WordCache(self.encoding.encode_ordinary)

    def encode(self, text: str) -> bytes:
        if UNSAFE.search(text):
            return b"".join(array("I", self.encoding.encode_ordinary(x)).tobytes() for x in pieces(text))
        first, *rest = text.split(" ")
        head = b"".join(array("I", self.encoding.encode_ordinary(x)).tobytes() for x in pieces(first))
        return head + b"".join(map(self.words.__getitem__, rest))


def pieces(text: str, size: int = LONG_RUN) -> list[str]:
    """The text cut at the first safe position after every ``size`` characters."""
    cuts, at = [0], size
    while at < len(text) and (m := SAFE.search(text, at)):
        cuts.append(m.start())
        at = m.start() + size
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


@functools.lru_cache(maxsize=4)
def encoder(rank_path: str, pattern: str) -> Encoder:
    """One encoder per process and file, so that tasks of one worker share the words they have met."""
    return Encoder(rank_path, pattern)


@functools.lru_cache(maxsize=4)
def added_tokens(tokenizer_path: str) -> tuple[Tokenizer, list[str]]:
    """A tokenizer file with the tokens that it finds in a text before any other."""
    own = Tokenizer.from_file(tokenizer_path)
    return own, [token.content for token in own.get_added_tokens_decoder().values()]
