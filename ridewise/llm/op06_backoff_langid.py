"""Language identification, word first, then shorter character n-grams.

Known words are scored by their log frequency in each language. A word that
training has not seen often enough backs off to the character n-grams of the
longest length at which it has a known one: 5, 4, 3, 2, 1. A text's language is
the one of greatest summed score; the reported score is the posterior of the
mean over its words.

The model is counted in Spark from at most about ``DOCS_PER_LANGUAGE``
documents a language, chosen by a hash of the text and id.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewise.llm.common import small_arrow_batches, stage

#: Bound of the training sample: documents of one language, on average.
DOCS_PER_LANGUAGE = 1000
#: A word or n-gram must occur this often in the sample to be known.
SEEN = 5
LONGEST = 5
SMOOTH = 0.5
UNKNOWN = "und"
WORD_CACHE = 200_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    return [w for w in _WORD.findall((text or "").lower()) if w.isalpha() or any(map(str.isalpha, w))]


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of the word between its ends, marked ``<`` and ``>``."""
    marked = f"<{word}>"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


class Model:
    """Log frequencies per language: level 0 of words, level n of n-grams."""

    def __init__(self, languages: list[str], counts: list[tuple[int, str, list[int]]]):
        self.languages = languages
        self.rows: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        width = max(1, len(languages))
        seen = np.array([c[2] for c in counts], dtype=np.float64).reshape(-1, width)
        levels = np.array([c[0] for c in counts], dtype=np.int64)
        for i, (level, unit, _) in enumerate(counts):
            self.rows[level][unit] = i
        self.logs = np.zeros_like(seen)
        for level in range(LONGEST + 1):
            own = levels == level
            self.logs[own] = np.log((seen[own] + SMOOTH) / (seen[own].sum(axis=0) + SMOOTH * (own.sum() + 1)))
        self.known: _Known | None = None

    def word(self, w: str) -> np.ndarray:
        """The word's log score in each language, of the first level that knows it."""
        if (i := self.rows[0].get(w)) is not None:
            return self.logs[i]
        for n in range(LONGEST, 0, -1):
            if hit := [self.rows[n][g] for g in grams(w, n) if g in self.rows[n]]:
                return self.logs[hit].mean(axis=0)
        return np.zeros(self.logs.shape[1])

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.languages:
            return UNKNOWN, 0.0
        if self.known is None:
            self.known = _Known(self)
        mean = self.known.mean(words)
        # first of equal languages, which are in alphabetical order
        best = int(mean.argmax())
        return self.languages[best], float(1 / np.exp(mean - mean[best]).sum())


class _Known(dict):
    """Words already scored, as rows of one matrix; emptied when it is full."""

    def __init__(self, model: Model):
        self.model = model
        self.scores = np.empty((WORD_CACHE, model.logs.shape[1]))

    def __missing__(self, word: str) -> int:
        self[word] = i = len(self)
        self.scores[i] = self.model.word(word)
        return i

    def mean(self, words: list[str]) -> np.ndarray:
        total = np.zeros(self.scores.shape[1])
        for a in range(0, len(words), 10_000):
            if len(self) + 10_000 > WORD_CACHE:
                self.clear()
            total += self.scores[list(map(self.__getitem__, words[a:a + 10_000]))].sum(axis=0)
        return total / len(words)


def train(docs: DataFrame) -> Model:
    """A model from rows (doc_id, text, lang); rows with a null lang or no word teach nothing.

    Units are counted by Spark; those of the bounded sample that occur SEEN
    times or more come to the driver and go to the workers as a broadcast.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    known = docs.where("lang is not null and text is not null")
    # stored, so that the planner knows its size: no text moves for it
    counts = stage(known.groupBy("lang").agg(F.count("*").alias("docs")), "languages")
    place = F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(6)), 11) / F.lit(float(2 ** 53))
    sample = known.join(counts, "lang").where(place < F.lit(float(DOCS_PER_LANGUAGE)) / F.col("docs")).select("lang", F.col("text").cast("string").alias("text"))

    def units(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            seen: Counter = Counter()
            for lang, text in zip(f["lang"], f["text"]):
                for w, n in Counter(words_of(text)).items():
                    seen[lang, 0, w] += n
                    for k in range(1, LONGEST + 1):
                        for g in grams(w, k):
                            seen[lang, k, g] += n
            yield pd.DataFrame([(*key, n) for key, n in seen.items()], columns=["lang", "level", "unit", "n"])

    rows = stage(sample.mapInPandas(units, "lang string, level int, unit string, n long")
                 .groupBy("lang", "level", "unit").agg(F.sum("n").alias("n")), "units")
    often = rows.groupBy("level", "unit").agg(F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")).where(F.col("all") >= SEEN)
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    table = often.select("level", "unit", F.array(*(F.coalesce(F.try_element_at("by", F.lit(x)), F.lit(0)) for x in languages)).alias("seen") if languages else F.array().alias("seen"))
    return Model(languages, [(r["level"], r["unit"], r["seen"]) for r in table.toLocalIterator()] if languages else [])


def predicted(spark: SparkSession, model: Model, text: Column) -> Column:
    """struct(lang, score) of a text; ``und`` and 0 for a null text or one without a letter."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang", "score"])

    return run(text)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; other columns than doc_id and text are ignored.

    Repeated rows and null ids stay as they are; with no model languages every
    text is ``und``. An empty table gives no rows.
    """
    small_arrow_batches(docs.sparkSession)
    found = docs.select("doc_id", predicted(docs.sparkSession, model, F.col("text").cast("string")).alias("p"))
    return found.select("doc_id", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
