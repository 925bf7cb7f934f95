"""Quality rules whose thresholds come from the data.

Each text is measured once. Every (language, source) gets KLL quantile
sketches of its measures; sketches merge, so those of a language, and of all
documents, are merged from the same rows. A group's limits are drawn towards
those of its language, and these towards everyone's, by as many rows as
``PRIOR`` against its own; there is no size from which a group counts. No limit
is a constant.

Shares are judged as square roots, in which a count's spread does not depend on
its size. A share's limit is the quantile that is reached from the ``FROM``
quantile upwards to ``UPTO`` in steps no wider than the chance variation of a
text of median size: junk lies past a gap, so the walk ends before it, also
where junk fills half of a group. The limit is at least one event in a text of
median size, the rate that quantiles of zero can't tell from none. A text may
pass the limit by as much as a count of its size varies by chance. Mean word
length, in which junk lies on both sides, has a lower and an upper limit around
the narrowest band of ``BAND`` tenths, which is at least as wide as a mean over
the words of a median text varies by chance (copies of one text make it
narrower). The limits are joined back to the documents by language and source.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewise.llm.common import small_arrow_batches, stage

#: How far a mean word length may lie from its group's band, in widths of it.
SPREAD = 6.0
#: Quantiles of a share between which its limit lies, and the steps of the walk.
FROM, UPTO, STEPS = 0.4, 0.98, 29
#: Tenths of a group in the band that tells the usual word length.
BAND = 4
#: Standard deviations of a text's own count that it may pass a limit by.
CHANCE = 3.0
#: Rows that the limits of a group's parent weigh as much as.
PRIOR = 10

_SYMBOL = re.compile(r"[#*$%&|<>]")


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a word) of a whole text."""
    text = text or ""
    lines = Counter()
    words: list[str] = []
    for line in text.split("\n"):
        # bytes split at ASCII white space only
        own = line.encode("utf-8", "surrogatepass").split()
        if own:
            lines[line] += 1
            words += own
    n = len(words)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeat = 0
    if len(windows) < n - 2:
        covered = 0                                    # words before this one are counted
        for i, w in enumerate(zip(words, words[1:], words[2:])):
            if windows[w] > 1:
                repeat += i + 3 - max(i, covered)
                covered = i + 3
    chars = sum(len(w.decode("utf-8", "surrogatepass")) for w in words) if not text.isascii() else sum(map(len, words))
    return n, chars, len(_SYMBOL.findall(text)), sum(lines.values()) - len(lines), repeat, sum(lines.values())


_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _measures(text: Column) -> Column:
    @F.pandas_udf(", ".join(f"{f} long" for f in _FIELDS))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([measure(t) for t in texts], columns=list(_FIELDS), dtype="int64")

    return run(text)


def _share(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


#: Each share's count, what it is a share of, and how much one event counts (one repeated window is six words).
SHARES = {"symbol_share": ("n_symbols", "word_chars", 1), "dup_line_share": ("n_dup_lines", "n_lines", 1), "repeat_share": ("n_repeat_words", "n_words", 6)}
SIZES = ("word_chars", "n_lines", "n_words")
MEASURES = {**{m: (lambda a=a, b=b: _share(a, b)) for m, (a, b, _) in SHARES.items()}, "word_length": lambda: _share("word_chars", "n_words")}


def _limits(sketch: DataFrame, keys: list[str], merge: bool) -> DataFrame:
    """(keys, docs, limits) of each group on its own; limits of shares are square roots."""
    def at(m: str, q: float) -> Column:
        return F.kll_sketch_get_quantile_double(m, F.lit(q))

    if merge:
        sketch = sketch.groupBy(*keys).agg(F.sum("docs").alias("docs"), *(F.kll_merge_agg_double(m).alias(m) for m in (*MEASURES, *SIZES)))
    cols = []
    for m, (_, size, event) in SHARES.items():
        median = F.greatest(at(size, 0.5), F.lit(1.0))
        step = F.lit(CHANCE / 2 * event ** 0.5) / F.sqrt(median)
        walk = [F.sqrt(at(m, FROM + (UPTO - FROM) * i / STEPS)) for i in range(STEPS + 1)]
        start = F.struct(walk[0].alias("at"), F.lit(True).alias("goes"))
        reach = F.aggregate(F.array(*walk), start, lambda a, x: F.struct(
            F.when(a["goes"] & (x - a["at"] <= step), x).otherwise(a["at"]).alias("at"), (a["goes"] & (x - a["at"] <= step)).alias("goes")))["at"]
        cols.append(F.greatest(reach, F.sqrt(F.lit(float(event)) / median)).alias(f"{m}_max"))
    tenths = [at("word_length", i / 10) for i in range(11)]
    band = F.array_min(F.array(*(F.struct((hi - lo).alias("width"), ((hi + lo) / 2).alias("centre")) for lo, hi in zip(tenths, tenths[BAND:]))))
    # a word's length varies by about half of the mean
    width = F.greatest(band["width"], band["centre"] / 2 / F.sqrt(F.greatest(at("n_words", 0.5), F.lit(1.0))))
    cols += [(band["centre"] + SPREAD * width).alias("word_length_max"), (band["centre"] - SPREAD * width).alias("word_length_min")]
    return sketch.where("docs > 0").select(*keys, "docs", F.struct(*cols).alias("limits"))


LIMITS = (*(f"{m}_max" for m in SHARES), "word_length_max", "word_length_min")


def _drawn(own: Column, docs: Column, parent: Column) -> Column:
    """Limits of a group of ``docs`` rows, drawn towards its parent's."""
    return F.struct(*(((docs * own[x] + PRIOR * parent[x]) / (docs + PRIOR)).alias(x) for x in LIMITS))


def quality_rules(docs: DataFrame) -> DataFrame:
    """The measures of every row, base_failed and kept.

    Takes doc_id, text, lang and source; others are ignored. base_failed:
    under 50 words, or over half of them in repeated 3-word windows. kept:
    not base_failed and within the limits of the row's (lang, source), give or
    take the chance variation of the row's own counts. A null
    text is empty. Null lang and null source are groups like others. Repeated
    rows are measured each. An empty table gives no rows.
    """
    small_arrow_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("null")).alias("lang_key"),
                       F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("source_key"),
                       _measures(F.col("text").cast("string")).alias("m"))
    rows = stage(rows.select("doc_id", "lang_key", "source_key", "m.*").withColumns({m: f() for m, f in MEASURES.items()}), "measures")
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # what fails the base rules says nothing about the others
    fine = rows.where(~base)
    sketches = stage(fine.groupBy("lang_key", "source_key").agg(F.count("*").alias("docs"), *(F.kll_sketch_agg_double(F.col(m).cast("double")).alias(m) for m in (*MEASURES, *SIZES))), "sketches")
    everyone = _limits(sketches, [], True).first()
    every = F.struct(*(F.lit(everyone["limits"][x] if everyone else None).cast("double").alias(x) for x in LIMITS))
    lang = _limits(sketches, ["lang_key"], True).select("lang_key", _drawn(F.col("limits"), F.col("docs"), every).alias("of_lang"))
    own = _limits(sketches, ["lang_key", "source_key"], False).join(lang, "lang_key").select(
        "lang_key", "source_key", _drawn(F.col("limits"), F.col("docs"), F.col("of_lang")).alias("limits"))
    # a group without limits has only rows that fail the base rules
    judged = rows.join(stage(own, "limits"), ["lang_key", "source_key"], "left")
    within = F.col("word_length").between(F.col("limits.word_length_min"), F.col("limits.word_length_max"))
    for m, (count, size, event) in SHARES.items():
        # the square root of a count varies by half
        within &= F.sqrt(count) <= F.col(f"limits.{m}_max") * F.sqrt(size) + CHANCE / 2 * event ** 0.5
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
                         (~base & F.coalesce(within, F.lit(False))).alias("kept"), *MEASURES, "limits")
