"""Quality scores by Bradley-Terry ranking.

Every text is described by a few shares (symbols, capitals, repeats, ...).
Each training document of label 1 is preferred to documents of label 0, and
the ranking weights are fitted by logistic loss on feature differences, with
no intercept: P(a over b) = 1 / (1 + exp(-w (f(a) - f(b)))). A document's
strength is w f; the threshold is the quantile of the training strengths under
which the share of label 0 lies. A score is the logistic of the strength's
distance to that threshold, set so that the threshold scores 0.3.

The fit runs in MLlib on every labelled document: they are numbered in buckets
of their ids' hash, paired by a join on the number, and the threshold is found
by counting, so no task and not the driver holds a label's documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewise.llm.common import shuffled, small_arrow_batches, stage

#: Documents of the other label that each training document is held against.
RIVALS = 8
#: The score at the threshold.
AT_THRESHOLD = 0.3
REGULARISATION = 1e-3
#: Documents that one bucket of the numbering holds, on average, and pairs that a task of the fit reads.
BUCKET_DOCS, TASK_PAIRS = 50_000, 100_000
#: Parts in which a round of the threshold's search counts strengths, and rows that it gathers at the end.
PARTS, FEW_ROWS = 1024, 4096

_SYMBOLS = re.compile(r"[#$%&*@^~=+\\/<>{}\[\]_]")
_MARKS = re.compile(r"[!?]")
_PIPES = re.compile(r"[|]")
_DIGITS = re.compile(r"[0-9]")
_STOPS = re.compile(r"[.,;:]")
FEATURES = ("symbols", "pipes", "marks", "capitals", "digits", "stops", "doubled", "repeated", "dup_lines", "distinct", "word_length", "short", "empty")


def describe(text: str | None) -> list[float]:
    """A text's features, each about 0 to 1; an empty text has only ``empty``."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    chars = sum(map(len, words))
    pairs = sum(a == b for a, b in zip(words, words[1:]))
    threes = Counter(zip(words, words[1:], words[2:]))
    repeated = sum(c for c in threes.values() if c > 1)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        min(1.0, len(_SYMBOLS.findall(text)) / chars * 4), min(1.0, len(_PIPES.findall(text)) / n * 2), min(1.0, len(_MARKS.findall(text)) / n),
        sum(w.isupper() for w in words) / n, len(_DIGITS.findall(text)) / chars, min(1.0, len(_STOPS.findall(text)) / n), min(1.0, pairs / n * 2),
        repeated / max(1, n - 2), 1 - len(set(lines)) / max(1, len(lines)), len(set(words)) / n, min(1.0, chars / n / 20), 1 / (1 + n / 20), 0.0,
    ]


def features(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([describe(t) for t in texts])

    return run(text)


@dataclass(frozen=True)
class Ranking:
    weights: tuple[float, ...]
    threshold: float

    def strength(self, f: Column) -> Column:
        w = F.array(*map(F.lit, self.weights))
        return F.aggregate(F.zip_with(f, w, lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)

    def score(self, f: Column) -> Column:
        """0 to 1; AT_THRESHOLD at the threshold."""
        at = float(np.log(AT_THRESHOLD / (1 - AT_THRESHOLD)))
        return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), self.strength(f) - self.threshold + at))))


def fit(docs: DataFrame, labels: DataFrame) -> Ranking | None:
    """Rank from texts (doc_id, text) and labels (doc_id, label); None without both labels.

    Labels other than 0 and 1 are none. Every labelled document is held against
    RIVALS of the other label, or all if there are fewer. Rows that share an id
    count once.
    """
    small_arrow_batches(docs.sparkSession)
    known = labels.where("label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    # dealt out by id at any size: the texts are shuffled once, for the join and for the rows that share an id
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(shuffled(known.distinct()), "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    training = stage(texts.select("doc_id", "label", features(F.col("text")).alias("f")), "training")
    sizes = {r["label"]: r["count"] for r in training.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    # rank 0.. in each label by hash; document i of the larger label meets RIVALS of the other from i * RIVALS on
    few = min(sizes.values())
    many = max(sizes.values())
    big = max(sizes, key=sizes.get)
    rivals = min(RIVALS, few)
    numbered = _numbered(training, sum(sizes.values()))
    lots = numbered.where(F.col("label") == big).select(F.col("f").alias("f_big"), F.explode(F.sequence(F.lit(0), F.lit(rivals - 1))).alias("r"), "i")
    lots = lots.select("f_big", F.pmod(F.col("i") * rivals + F.col("r"), F.lit(few)).alias("j"), ((F.col("i") + F.col("r")) % 2).alias("turn"))
    some = numbered.where(F.col("label") != big).select(F.col("f").alias("f_few"), (F.col("i") - 1).alias("j"))
    sign = F.lit(1.0 if big == 1 else -1.0)
    better = F.zip_with("f_big", "f_few", lambda a, b: (a - b) * sign)
    # half of the pairs are told from the loser's side, so that both outcomes occur
    pairs = lots.join(shuffled(some), "j").select(
        F.when(F.col("turn") == 1, better).otherwise(F.transform(better, lambda x: -x)).alias("d"), F.col("turn").cast("double").alias("won"))
    tasks = max(1, min(8, many * rivals // 5000), many * rivals // TASK_PAIRS)
    pairs = stage(pairs.select(array_to_vector("d").alias("features"), "won"), "pairs").coalesce(tasks)
    model = LogisticRegression(featuresCol="features", labelCol="won", fitIntercept=False, standardization=False,
                               regParam=REGULARISATION, maxIter=60).fit(pairs.cache())
    pairs.unpersist()
    ranking = Ranking(tuple(float(x) for x in model.coefficients), 0.0)
    # the quantile among all training strengths, each label weighted to the number of its rows
    weight = {label: counts[label] / sizes[label] for label in (0, 1)}
    strengths = stage(training.select(ranking.strength(F.col("f")).alias("s"), "label"), "strengths")
    at = _middle(strengths, weight, counts[0] / (counts[0] + counts[1]) * sum(weight[k] * sizes[k] for k in (0, 1)))
    return ranking if at is None else Ranking(ranking.weights, at)


def _numbered(rows: DataFrame, n: int) -> DataFrame:
    """(label, f, i): ``i`` counts each label's documents from 1 on, by the hash of their ids.

    Ranks are taken in buckets of the hash; a bucket's first number is the count
    of the smaller ones, from a table of a row a label and bucket.
    """
    place = F.xxhash64("doc_id", F.lit(5))
    bits = max(0, (n // BUCKET_DOCS).bit_length())
    bucketed = rows.withColumns({"place": place, "bucket": F.shiftright(place, 64 - bits) if bits else F.lit(0).cast("long")})
    before = Window.partitionBy("label").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = bucketed.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "label", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("label", "bucket").orderBy("place", "doc_id"))
    return bucketed.withColumn("rank", rank).join(first, ["label", "bucket"]).select("label", "f", (F.col("first") + F.col("rank")).alias("i"))


def _middle(rows: DataFrame, weight: dict[int, float], target: float) -> float | None:
    """The middle between the row that brings the weight up to ``target``, in order of ``s``, and the next row; None if there is none.

    rows: (s, label). The range that holds the place is cut into PARTS until it
    holds few rows or one value; a round counts, and gathers a row a part.
    """
    label = {k: F.count_if(F.col("label") == k).alias(f"n{k}") for k in (0, 1)}
    lo, hi, n = rows.agg(F.min("s"), F.max("s"), F.count("s")).first()
    below, inside = 0.0, rows
    while n > FEW_ROWS and lo < hi:
        part = F.least(F.floor((F.col("s") - lo) / F.lit(hi - lo) * PARTS), F.lit(PARTS - 1)).alias("part")
        parts = inside.groupBy(part).agg(*label.values(), F.min("s").alias("lo"), F.max("s").alias("hi")).orderBy("part").collect()
        for p in parts:
            own = weight[0] * p["n0"] + weight[1] * p["n1"]
            if below + own >= target:
                break
            below += own
        else:
            return None
        lo, hi, n = p["lo"], p["hi"], p["n0"] + p["n1"]
        inside = rows.where(F.col("s").between(lo, hi))
    # at most FEW_ROWS rows, or two: one value's counts by label
    groups = inside.groupBy("s", "label").count().orderBy("s", "label").collect()
    for g, after in zip(groups, [*groups[1:], None]):
        w = weight[g["label"]]
        if below + w * g["count"] >= target:
            if below + w * (g["count"] - 1) >= target:
                return g["s"]
            above = after["s"] if after else rows.where(F.col("s") > hi).agg(F.min("s")).first()[0]
            return None if above is None else (g["s"] + above) / 2
        below += w * g["count"]
    return None


def scored(docs: DataFrame, ranking: Ranking | None, text: str | Column = "text") -> DataFrame:
    """``docs`` with score (double, 0 to 1) and predicted (1 if score >= 0.3, else 0).

    Every text gets a score, null and empty ones too. Without a ranking (no
    labels of both kinds) all score 0.5.
    """
    small_arrow_batches(docs.sparkSession)
    c = F.col(text) if isinstance(text, str) else text
    score = F.lit(0.5) if ranking is None else ranking.score(features(c.cast("string")))
    return docs.withColumn("score", score).withColumn("predicted", (F.col("score") >= AT_THRESHOLD).cast("int"))
