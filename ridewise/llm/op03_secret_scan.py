"""Secrets in texts: fixed patterns, and strings a tokenizer can't compress.

Three patterns are the base (assignments, access keys, hexadecimal runs). The
token-efficiency test adds strings of key characters with few characters a token
under a tiktoken vocabulary: words and names are in the vocabulary in long
pieces, random strings are not.

Runs of key characters are cut at base spans and at known kinds of identifiers
(digests, UUIDs, dates), and what is left into parts at signs. Each part speaks
for a key by as many characters as it lacks to ``EFFICIENCY``, or against it;
the stretches of parts that speak most for a key are tested, so words around a
key do not hide it and signs in a key do not break it. Numbers say nothing.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewise.llm.common import small_arrow_batches

# fixed values: the base patterns, their least lengths and their order
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "random")

#: What a text without an assignment lacks (all of them, in lower case).
_WORDS = ("passw", "secret", "token", "api")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{12,}")
_PART = re.compile(r"[A-Za-z0-9]+")
#: A part of one word, or of several with capitals.
_WORD = re.compile(r"[A-Z]+|[A-Za-z]?[a-z]*([A-Z][a-z]{2,})*")
#: Fewer characters a token than this is random.
EFFICIENCY = 2.0
#: The least length of a random part, of one that has a word's shape, and of several parts together.
LEAST, WORD_LEAST, JOINED_LEAST = 12, 20, 20
#: Parts of up to this length go with a random neighbour.
SHORT_PART = 3
#: A part of a word's shape under WORD_LEAST letters is random under this (words of clean texts reach down to it).
SHORT_WORD_EFFICIENCY = 1.4
#: Lengths of hexadecimal digests: md5, sha1, sha224, sha256, sha384, sha512.
DIGESTS = (32, 40, 56, 64, 96, 128)
_IDENTIFIER = re.compile(
    r"(?<![A-Za-z0-9])(?:"
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"    # UUID
    r"|\d{4}-\d{2}-\d{2}[T_-]?[0-9Z+_-]*"                      # dates and times
    r"|\d{8}T\d{4,6}Z?"
    r")(?![A-Za-z0-9])"
)


def known_identifier(part: str, digests: frozenset[str] = frozenset()) -> bool:
    """Whether a part is an identifier that is no secret."""
    return part in digests or (len(part) in DIGESTS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", part) is not None)


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _weight(part: str, vocab: tiktoken.Encoding, digests: frozenset[str]) -> tuple[float, bool]:
    """How much a part speaks for a key, and whether it may be one alone."""
    n = len(part)
    if part.isdecimal():
        return 0.0, False
    if known_identifier(part, digests):
        return -1e9, False
    tokens = len(vocab.encode_ordinary(part))
    weight = EFFICIENCY * tokens - n
    if n < WORD_LEAST and _WORD.fullmatch(part):
        if n >= LEAST and n < SHORT_WORD_EFFICIENCY * tokens:
            return weight, True
        return min(weight, 0.0), False
    return weight, n >= LEAST and weight > 0


def _random(text: str, start: int, end: int, vocab: tiktoken.Encoding, digests: frozenset[str]) -> Iterator[tuple[int, int]]:
    """The stretches of parts of text[start:end] that are random.

    They are the maximal scoring stretches of the parts' weights (Ruzzo and
    Tompa, 1999).
    """
    stretches: list[tuple[float, float, int, int, bool]] = []        # sum before, sum with, first, last, a key alone
    final = []
    total = 0.0
    parts = list(_PART.finditer(text, start, end))
    for i, p in enumerate(parts):
        weight, alone = _weight(p[0], vocab, digests)
        before, total = total, total + weight
        if weight <= 0:
            continue
        new = (before, total, i, i, alone)
        while True:
            j = next((j for j in reversed(range(len(stretches))) if stretches[j][0] < new[0]), None)
            if j is None:                              # nothing reaches back over the least sum
                final += stretches
                stretches = [new]
                break
            if stretches[j][1] >= new[1]:
                stretches.append(new)
                break
            old = stretches[j]
            new = (old[0], new[1], old[2], new[3], any(s[4] for s in stretches[j:]) or new[4])
            del stretches[j:]
    at = 0
    for _, _, i, j, alone in final + stretches:
        if alone or sum(len(p[0]) for p in parts[i:j + 1]) >= JOINED_LEAST:
            # a key's own short parts and signs at its ends
            while i > at and len(parts[i - 1][0]) <= SHORT_PART and parts[i].start() - parts[i - 1].end() <= 2:
                i -= 1
            while j + 1 < len(parts) and len(parts[j + 1][0]) <= SHORT_PART and parts[j + 1].start() - parts[j].end() <= 2:
                j += 1
            i = max(i, at)
            if i <= j:
                yield parts[i].start(), end if j + 1 == len(parts) else parts[j].end()
            at = max(at, j + 1)


def find(text: str | None, vocab: tiktoken.Encoding, digests: frozenset[str] = frozenset()) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, secret's start, secret's end) by start, then kind; a whole text, in code points."""
    text = text or ""
    found = []
    small = text.lower()
    if any(w in small for w in _WORDS):
        found += [("assign", *m.span(), *m.span(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span(), *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [("hex", *m.span(), *m.span()) for m in HEX.finditer(text)]
    taken = sorted(f[1:3] for f in found)
    for m in _RUN.finditer(text):
        if m[0] in digests:
            continue
        cuts = [(a, b) for a, b in taken if a < m.end() and m.start() < b]
        cuts += [(m.start() + i.start(), m.start() + i.end()) for i in _IDENTIFIER.finditer(m[0])]
        at = m.start()
        for a, b in [*sorted(cuts), (m.end(), m.end())]:
            if a - at >= LEAST:
                found += [("random", x, y, x, y) for x, y in _random(text, at, a, vocab, digests)]
            at = max(at, b)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def masked(text: str, found: list[tuple[str, int, int, int, int]], mark: str) -> str:
    """The text with each secret (overlapping ones together) replaced by ``mark``."""
    out, at = [], 0
    for a, b in sorted(s[3:] for s in found):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


_SCAN = "kinds array<string>, starts array<int>, ends array<int>, secret_starts array<int>, secret_ends array<int>, masked string"


def scanned(text: Column, path: str, pattern: str, digests: frozenset[str] = frozenset(), mark: str = "<secret>") -> Column:
    """struct(spans, masked): spans as structs (kind, start, end, secret_start, secret_end); masked is null without spans."""

    @F.pandas_udf(_SCAN)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(path, pattern)
        for texts in batches:
            rows = []
            for t in texts:
                found = find(t, vocab, digests)
                kinds, *places = map(list, zip(*found)) if found else ([], [], [], [], [])
                rows.append((kinds, *places, masked(t, found, mark) if found else None))
            yield pd.DataFrame(rows, columns=["kinds", "starts", "ends", "secret_starts", "secret_ends", "masked"])

    return run(text)


def scan_documents(docs: DataFrame, path: str, pattern: str, digests: frozenset[str] = frozenset()) -> DataFrame:
    """(doc_id, spans) of every row of ``docs``; one pass, no shuffle.

    Takes doc_id and text; others are ignored. spans: structs (kind, start,
    end) by start, then kind. A null or empty text has none. Repeated rows
    and null ids stay as they are; an empty table gives no rows.
    """
    small_arrow_batches(docs.sparkSession)
    rows = docs.select("doc_id", scanned(F.col("text").cast("string"), path, pattern, digests).alias("s"))
    return rows.select("doc_id", F.zip_with(F.arrays_zip("s.kinds", "s.starts"), "s.ends", lambda a, e: F.struct(
        a["kinds"].alias("kind"), a["starts"].alias("start"), e.alias("end"))).alias("spans"))


def mask_documents(docs: DataFrame, path: str, pattern: str, digests: frozenset[str] = frozenset()) -> DataFrame:
    """``docs`` with its secrets masked; n_chars, if there is one, follows the text. No row goes."""
    small_arrow_batches(docs.sparkSession)
    rows = docs.select(F.struct(*docs.columns).alias("row"), scanned(F.col("text").cast("string"), path, pattern, digests).alias("s"))
    new = F.coalesce("s.masked", "row.text")
    changed = {"text": new, "n_chars": F.when(F.col("s.masked").isNull(), F.col("row.n_chars")).otherwise(F.length(new).cast("long")) if "n_chars" in docs.columns else None}
    return rows.select(*((changed[c] if c in changed else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
