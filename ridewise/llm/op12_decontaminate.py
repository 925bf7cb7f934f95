"""Benchmark decontamination with an Aho-Corasick automaton over words.

Test texts and documents are normalised alike: A-Z in lower case, words are
runs of digits, letters and characters beyond ASCII. Every window of ``n``
consecutive words of a test text (the whole text, if it is shorter) is a key of
one automaton whose alphabet is the words of the benchmark; a document's words
run through it once, words that no test text has reset it. A word is hit when
it lies inside any occurrence. Hits are mapped back to code points of the
original text.

The automaton goes to the tasks. A benchmark of more than ``AUTOMATON_BYTES``
of text is cut into parts of at most that (of whole test texts, the longest of
which sets the least size); the documents then pass one automaton after the
other, each pass stored, and the hits add up, so nothing depends on the
benchmark's size but the number of passes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import repeat

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewise.llm.common import small_arrow_batches, stage

WINDOW = 10
AUTOMATON_BYTES = 4 << 20
#: A-Z in lower case; digits, lower-case letters and bytes beyond ASCII stay; all else parts words.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")


def words(text: str | None) -> list[bytes]:
    """The normalised words of a text, as UTF-8; null has none."""
    return (text or "").encode("utf-8").translate(_NORMAL).split()


class Windows:
    """The automaton of some test texts."""

    def __init__(self, items: Sequence[tuple[str | None, str]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        keys: dict[tuple[int, ...], set[str | None]] = {}
        for item, text in items:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text))
            for i in range(max(1, len(ids) - n + 1) if ids else 0):
                keys.setdefault(ids[i:i + n], set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, owners in keys.items():
            self.automaton.add_word(key, (len(key), tuple(owners)))
        self.empty = not keys
        if keys:
            self.automaton.make_automaton()

    def find(self, found: Sequence[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Runs of hit words (first, end) in order, and the test texts that occur."""
        runs: list[tuple[int, int]] = []
        items: set[str | None] = set()
        if self.empty or not found:
            return runs, items
        for last, (length, owners) in self.automaton.iter(tuple(map(self.vocabulary.get, found, repeat(0)))):
            first = last + 1 - length
            while runs and first <= runs[-1][1]:      # ends ascend, so only the last runs can touch
                first = min(first, runs.pop()[0])
            runs.append((first, last + 1))
            items.update(owners)
        return runs, items


def _united(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted([*a, *b]):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def offsets(text: str, runs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code points (start, end) of runs of words in the original text."""
    raw = text.encode("utf-8")
    places = [m.span() for m in _WORD.finditer(raw.translate(_NORMAL))]
    out, at, point = [], 0, 0
    for first, end in runs:
        span = []
        for byte in (places[first][0], places[end - 1][1]):
            point += len(raw[at:byte].decode("utf-8"))
            at = byte
            span.append(point)
        out.append((span[0], span[1]))
    return out


_HITS = "n_words long, firsts array<int>, ends array<int>, items array<string>, nameless boolean"


def _scanned(text: Column, before: Column, items: list[tuple[str | None, str]], n: int) -> Column:
    """The hits of one automaton, added to those found before."""

    @F.pandas_udf(_HITS)
    def run(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        windows = Windows(items, n)
        for texts, earlier in batches:
            rows = []
            for t, firsts, ends, names, nameless in zip(texts, *(earlier[c] for c in ("firsts", "ends", "items", "nameless"))):
                found = words(t)
                runs, own = windows.find(found)
                if firsts is not None and len(firsts):
                    runs = _united(runs, [(int(a), int(b)) for a, b in zip(firsts, ends)])
                    own |= set(names)
                nameless = bool(nameless) or None in own
                rows.append((len(found), [a for a, _ in runs], [b for _, b in runs], sorted(own - {None}), nameless))
            yield pd.DataFrame(rows, columns=["n_words", "firsts", "ends", "items", "nameless"])

    return run(text, before)


def _spans(text: Column, firsts: Column, ends: Column) -> Column:
    @F.pandas_udf("array<struct<start: int, end: int>>")
    def run(texts: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([[{"start": x, "end": y} for x, y in offsets(t, list(zip(p, q)))] for t, p, q in zip(texts, a, b)], dtype=object)

    return F.when(F.size(firsts) > 0, run(F.coalesce(text, F.lit("")), firsts, ends)).otherwise(F.array().cast("array<struct<start: int, end: int>>"))


def _parts(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[str | None, str]]]:
    """The benchmark's rows in parts of at most AUTOMATON_BYTES, fetched one partition at a time."""
    part, held = [], 0
    for row in benchmark.select(F.col(item).cast("string"), F.col(text).cast("string")).where(f"`{text}` is not null").distinct().toLocalIterator():
        size = len(row[1].encode("utf-8"))
        if part and held + size > AUTOMATON_BYTES:
            yield part
            part, held = [], 0
        part.append((row[0], row[1]))
        held += size
    yield part


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, text: str = "text", item: str = "item_id",
                       item_text: str = "text", spans: bool = True) -> DataFrame:
    """``docs`` beside a struct ``hits`` and, if asked for, an array ``spans``: struct(row, hits, spans).

    row holds the columns of ``docs``. hits: n_words; firsts and ends, the runs
    of hit words (word numbers from 0, end exclusive, in order, apart);
    items, the ids of the test texts that occur, as strings in order of code
    points, each once; nameless, whether one without an id occurs. spans: the runs as code
    points (start, end) of the original text.

    A null or empty text has no words and no hits, a null or wordless test text
    has no windows. Rows of one item id are one item; equal rows count once.
    Repeated documents and null ids stay as they are. An empty table gives no
    rows, an empty benchmark no hits.
    """
    small_arrow_batches(docs.sparkSession)
    none = F.lit(None).cast("array<int>")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.struct(
        F.lit(0).cast("long").alias("n_words"), none.alias("firsts"), none.alias("ends"),
        F.lit(None).cast("array<string>").alias("items"), F.lit(False).alias("nameless")).alias("hits"))
    whole = F.col(f"row.`{text}`").cast("string")
    for k, part in enumerate(_parts(benchmark, item, item_text)):
        rows = (stage(rows, "decontaminate") if k else rows).select("row", _scanned(whole, F.col("hits"), part, n).alias("hits"))
    if not spans:
        return rows
    return rows.select("row", "hits", _spans(whole, F.col("hits.firsts"), F.col("hits.ends")).alias("spans"))


def cleaned(found: DataFrame, text: str = "text", mark: str = " ") -> DataFrame:
    """The documents with every hit span replaced by ``mark``; null texts stay null, columns stay as they are."""
    whole = F.col(f"row.`{text}`")
    starts = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["end"]))
    stops = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.length(whole)))
    kept = F.zip_with(starts, stops, lambda a, b: F.substring(whole, a + 1, b - a))
    new = F.when(F.size("spans") > 0, F.array_join(kept, mark)).otherwise(whole)
    return found.select(*((new if c == text else F.col(f"row.`{c}`")).alias(c) for c in found.schema["row"].dataType.names))
