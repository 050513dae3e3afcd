"""Byte-level BPE ids of whole texts, with a bounded cache of words.

The vocabulary of ``byte_bpe_50k.json`` is read from its published list of ranks, which a faster encoder understands; the
tests hold its ids against those of the JSON file. A text is cut before each white space that follows a
word. No token of this vocabulary reaches across such a place, so words can be encoded alone and remembered.
"""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache

import public_tokenizers
import tiktoken

RANKS = "byte_bpe_50k.tiktoken"
CACHED_WORDS = 300_000  # further words are encoded each time they occur

_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER_SPACE = re.compile(r"[^\S \n]")


class _Words(dict):
    def __init__(self, encoding: tiktoken.Encoding):
        self.encoding = encoding

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encoding.encode_ordinary(word)).tobytes()
        if len(self) < CACHED_WORDS:
            self[word] = ids
        return ids


class _Counts(dict):
    """Numbers of ids of a word under several tokenizers, 32 bits each in one number, so that one sum adds them all."""

    def __init__(self, encodings: list[tiktoken.Encoding]):
        self.encodings = encodings

    def __missing__(self, word: str) -> int:
        number = sum(len(e.encode_ordinary(word)) << 32 * i for i, e in enumerate(self.encodings))
        if len(self) < CACHED_WORDS:
            self[word] = number
        return number


def _encoding(ranks_path: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def words_of(ranks_path: str) -> _Words:
    """The encoder of a rank file, once per Python worker."""
    return _Words(_encoding(ranks_path))


@lru_cache(maxsize=4)
def counts_of(ranks_paths: tuple[str, ...]) -> _Counts:
    """The counter of several rank files, once per Python worker."""
    return _Counts([_encoding(path) for path in ranks_paths])


def count(text: str | None, counts: _Counts) -> list[int]:
    """Number of ids of a text under each tokenizer; a text has fewer than 2**32 of them."""
    if not text:
        return [0] * len(counts.encodings)
    if _OTHER_SPACE.search(text):
        return [len(e.encode_ordinary(text)) for e in counts.encodings]
    total = sum(map(counts.__getitem__, _CHUNK.findall(text)))
    return [total >> 32 * i & 0xFFFFFFFF for i in range(len(counts.encodings))]


def default_ranks() -> str:
    return str(public_tokenizers.path(RANKS))


def encode(text: str | None, words: _Words) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers; no special tokens."""
    if not text:
        return b""
    if _OTHER_SPACE.search(text):  # tabs and the like may join a following blank
        return array("I", words.encoding.encode_ordinary(text)).tobytes()
    return b"".join(map(words.__getitem__, _CHUNK.findall(text)))
