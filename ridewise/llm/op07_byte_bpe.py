"""Byte-level BPE encoding and decoding.

A text is cut by the tokenizer's pattern, and each piece is merged by rank on
its own. A segment tree over the piece's byte positions keeps, for every
position where a token starts, the rank of the pair it forms with its right
neighbour; the root is the leftmost pair of least rank. A merge sets the leaf
of the right half to "none" and updates the leaves of the merged token and of
its left neighbour: three logarithmic updates, so a piece of n bytes takes
O(n log n) whatever its length.

Vocabularies are rank files (base64 token, rank), read once a Python worker
from a path every executor can open. Short pieces repeat, so their ids are kept
in a cache that is bounded by bytes and emptied when a task ends. Encoding,
decoding and the comparison with the text are one function, so a task has one
Python worker.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewise.llm.common import small_arrow_batches

#: What the cache of pieces may take, what one of its entries takes beside its piece and ids, and the longest piece it holds.
PIECE_CACHE_BYTES, ENTRY_BYTES, CACHED_CHARS = 128 << 20, 180, 64
NO_PAIR = 1 << 30
POSITION_BITS = 32
POSITION = (1 << POSITION_BITS) - 1
NONE_LEFT = NO_PAIR << POSITION_BITS

#: Latin text without characters on whose class the two regex engines differ
#: (superscripts, fractions, control characters): there Python's own engine
#: gives the same pieces as ``regex``, twice as fast.
_OTHER = re.compile("[^\t-\r\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece of at least two bytes."""
    n, m, rank = len(piece), len(piece) - 1, ranks.get
    # leaf m + i: rank and position of the pair that starts at byte i
    tree = [0] * m + [rank(piece[i:i + 2], NO_PAIR) << POSITION_BITS | i for i in range(m)]
    for k in range(m - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    right = list(range(1, n + 1))          # where the token at i ends
    left = list(range(-1, n))              # where the token before i starts
    while (least := tree[1]) < NONE_LEFT:
        i = least & POSITION
        gone = right[i]
        end = right[i] = right[gone]
        if end < n:
            left[end] = i
            # the pair's right half is not a start any more; its own pair goes
            changed = [(m + gone, NONE_LEFT), (m + i, rank(piece[i:right[end]], NO_PAIR) << POSITION_BITS | i)]
        else:
            changed = [(m + i, NONE_LEFT)] if gone == m else [(m + gone, NONE_LEFT), (m + i, NONE_LEFT)]
        if i:
            p = left[i]
            changed.append((m + p, rank(piece[p:end], NO_PAIR) << POSITION_BITS | p))
        for k, value in changed:
            tree[k] = value
            while k > 1:
                other = tree[k ^ 1]
                k >>= 1
                if other < value:
                    value = other
                if tree[k] == value:
                    break
                tree[k] = value
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:right[i]]])
        i = right[i]
    return ids


class _Pieces(dict):
    """piece -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.held = ranks, 0

    def clear(self) -> None:
        super().clear()
        self.held = 0

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8")
        whole = self.ranks.get(raw)
        ids = merge_piece(raw, self.ranks) if whole is None else [whole]
        packed = pack(f"<{len(ids)}I", *ids)
        if len(piece) <= CACHED_CHARS:
            self.held += ENTRY_BYTES + len(raw) + len(packed)
            if self.held > PIECE_CACHE_BYTES:
                self.clear()
            self[piece] = packed
        return packed


class Tokenizer:
    """One vocabulary: ``encode`` to packed ids, ``decode`` to bytes."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        latin = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
        self.split_latin = re.compile(latin).findall if "\\p" not in latin else self.split
        self.pieces = _Pieces(self.ranks)

    def encode(self, text: str) -> bytes:
        split = self.split if _OTHER.search(text) else self.split_latin
        return b"".join(map(self.pieces.__getitem__, split(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> Tokenizer:
    return Tokenizer(path, pattern)


_ROUND_TRIP = "token_ids binary, decoded_sha256 string, decodes boolean"


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """struct(token_ids, decoded_sha256, decodes) of a text; null counts as the empty one.

    token_ids are little-endian unsigned 32-bit integers; decoded_sha256 is the
    digest of the bytes that they stand for, decodes says that those are the text.
    """

    @F.pandas_udf(_ROUND_TRIP)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = tokenizer(path, pattern)
        try:
            for texts in batches:
                rows = []
                for text in texts:
                    ids = own.encode(text or "")
                    back = own.decode(ids)
                    rows.append((ids, hashlib.sha256(back).hexdigest(), back == (text or "").encode("utf-8")))
                yield pd.DataFrame(rows, columns=["token_ids", "decoded_sha256", "decodes"])
        finally:
            own.pieces.clear()

    return run(text)


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that packed token ids stand for; null ids: null."""

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = tokenizer(path, pattern)
        for packed in batches:
            yield pd.Series([None if p is None else own.decode(p) for p in packed], dtype=object)

    return decode(ids)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, token_ids, decoded_sha256, decodes) of every row; one pass, no shuffle.

    Takes columns doc_id and text; others are ignored. A null or empty text
    has no tokens; repeated rows and null ids stay as they are; an empty table
    gives no rows.
    """
    small_arrow_batches(docs.sparkSession)
    rows = docs.select("doc_id", round_trip(F.col("text").cast("string"), path, pattern).alias("r"))
    return rows.select("doc_id", "r.*")


def decode_documents(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, token_ids, decoded) of rows (doc_id, token_ids), the bytes themselves."""
    small_arrow_batches(rows.sparkSession)
    return rows.select("doc_id", "token_ids", decoded(F.col("token_ids"), path, pattern).alias("decoded"))
