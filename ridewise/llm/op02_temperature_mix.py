"""Temperature mixing of sources.

A source's weight is its token share to the power alpha, normalised. alpha is
bisected: the largest that reaches a target entropy, or the smallest that
repeats no source more often than a limit allows. Weights become budgets in
tokens, and budgets become passes: a source is taken in whole epochs and a
last part of one, each epoch in a permutation of its own. The stream is cut
into blocks in each of which every source has its budget; inside a block rows
are permuted.

By default the budget is the least that keeps every document at least once,
so mixing repeats documents of small sources and drops none. An explicit
budget may also take only part of a source.

DataFrame functions only. The driver sees 31 rows a bisection pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewise.llm.common import stage, utf8
from ridewise.llm.weighted_cut import hash_key, weighted_cuts

#: A source may be repeated this often (epochs).
MAX_EPOCHS = 2.0
BLOCKS = 64
#: Buckets of one epoch of a source; a block takes whole buckets.
BUCKET_BITS = 9
#: UTF-8 bytes a token, by which tokens are told from bytes. Under byte_bpe_50k English has 2.6, German, French
#: and Spanish 2.2 to 2.5, Japanese 2.2, code and URLs 2.0; only the ratios between sources matter.
BYTES_A_TOKEN = 2.5


@dataclass
class MixPlan:
    alpha: float
    budget: float
    #: grp, weight, epochs, c1: the last, partial epoch takes keys <= c1
    sources: DataFrame
    #: grp, epoch, bucket, block
    buckets: DataFrame


def source_key(c: str = "source") -> Column:
    """A source's name as a join key; null is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))


def mix_columns(seed: int) -> dict[str, Column]:
    """What a row of documents brings: source key, tokens (from its bytes, so that no script needs spaces), permutation base."""
    return {"grp": source_key(), "n_tokens": F.ceil(F.octet_length(utf8("text")) / F.lit(BYTES_A_TOKEN)).cast("long"),
            "base": F.xxhash64("doc_id", "text", F.lit(seed))}


def _key(epoch: Column) -> Column:
    return hash_key("base", epoch)


def _search(sources: DataFrame, holds) -> float:
    """The smallest alpha in [0, 1] for which ``holds`` (a test that stays true as alpha grows).

    Each pass takes five bisection steps: it evaluates the 31 points they may
    visit in one job.
    """
    lo, hi = 0.0, 1.0
    for _ in range(4):
        grid = [lo + (hi - lo) * i / 32 for i in range(1, 32)]
        alphas = F.explode(F.array(*map(F.lit, grid))).alias("alpha")
        power = sources.where("tokens > 0").select("tokens", alphas).withColumn("ln", F.col("alpha") * F.log(F.col("tokens").cast("double")))
        # sums of exp, with the largest taken out first
        top = math.log(max(1, sources.agg(F.max("tokens")).first()[0] or 1))
        e = F.exp(F.col("ln") - F.col("alpha") * F.lit(top))
        got = {r["alpha"]: r for r in power.groupBy("alpha").agg(
            F.sum(e).alias("z"), F.sum(e * (F.col("ln") - F.col("alpha") * F.lit(top))).alias("zl"),
            (F.max(F.col("ln") - F.log(F.col("tokens").cast("double"))) - F.min(F.col("ln") - F.log(F.col("tokens").cast("double")))).alias("ratio")).collect()}
        for _ in range(5):
            if not got:
                return lo
            mid = (lo + hi) / 2
            r = got[min(got, key=lambda a: abs(a - mid))]
            if holds(math.log(r["z"]) - r["zl"] / r["z"], math.exp(r["ratio"])):
                hi = mid
            else:
                lo = mid
    return hi


def mixing_plan(rows: DataFrame, max_epochs: float | None = MAX_EPOCHS, entropy: float | None = None,
                budget: int | None = None, blocks: int = BLOCKS) -> MixPlan:
    """The plan for rows (grp, n_tokens, base).

    max_epochs: repetition limit between the most and the least repeated
    source. entropy: the least entropy wanted, as a part of that of equal
    weights; where both are given the limit wins. With neither, weights are
    the token shares.
    """
    sources = stage(rows.groupBy("grp").agg(F.sum("n_tokens").alias("tokens")), "sources")
    n = sources.where("tokens > 0").count()
    alpha = 1.0
    if entropy is not None and n > 1:
        want = entropy * math.log(n)
        # entropy falls as alpha grows: the first alpha below it, less a step
        alpha = max(0.0, _search(sources, lambda h, _: h < want) - 2.0 ** -20)
    if max_epochs is not None:
        least = _search(sources, lambda _, ratio: ratio <= max_epochs)
        alpha = least if entropy is None else max(alpha, least)
    raw = sources.withColumn("raw", F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(alpha))).otherwise(F.lit(0.0)))
    z = raw.agg(F.sum("raw").alias("z"), F.max(F.when(F.col("raw") > 0, F.col("tokens") / F.col("raw"))).alias("need")).first()
    tokens = float(budget) if budget is not None else (z["z"] or 0.0) * (z["need"] or 0.0)
    weighted = raw.select("grp", "tokens", (F.col("raw") / F.lit(z["z"] or 1.0)).alias("weight"))
    epochs = F.when(F.col("tokens") > 0, F.lit(tokens) * F.col("weight") / F.col("tokens")).otherwise(F.lit(1.0))
    weighted = weighted.withColumn("epochs", epochs).withColumn("whole", F.floor(F.col("epochs") + 1e-9).cast("int"))
    weighted = stage(weighted.withColumn("part", F.greatest(F.col("epochs") - F.col("whole"), F.lit(0.0)) * F.col("tokens")), "weights")
    last = rows.join(weighted.where("part >= 1").select("grp", "whole"), "grp").select(
        "grp", _key(F.col("whole")).alias("k1"), F.lit(0).cast("long").alias("k2"), F.col("n_tokens").alias("w"))
    cuts = weighted_cuts(last, weighted.where("part >= 1").select("grp", F.col("part").alias("target")), 0.0)
    sources = stage(weighted.join(cuts.select("grp", "c1"), "grp", "left").select("grp", "tokens", "weight", "epochs", "whole", F.coalesce("c1", F.lit(-1)).alias("c1")), "mix")
    sums = _passes(rows, sources).groupBy("grp", "epoch", "bucket", "weight").agg(F.sum("n_tokens").alias("t"))
    before = Window.partitionBy("grp").orderBy("epoch", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    share = F.coalesce(F.sum("t").over(before), F.lit(0)) / F.greatest(F.sum("t").over(Window.partitionBy("grp")), F.lit(1))
    buckets = stage(sums.select("grp", "epoch", "bucket", F.least(F.floor(share * blocks), F.lit(blocks - 1)).cast("int").alias("block")), "buckets")
    return MixPlan(alpha, tokens, sources, buckets)


def _passes(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """A row for each epoch that takes it."""
    taken = rows.join(sources.select("grp", "weight", "whole", "c1"), "grp")
    part = _key(F.col("whole")) <= F.col("c1")
    upto = F.col("whole") - F.when(part, F.lit(0)).otherwise(F.lit(1))
    epochs = F.when(upto >= 0, F.sequence(F.lit(0), upto)).otherwise(F.array().cast("array<int>"))
    dealt = taken.withColumn("epoch", F.explode(epochs)).withColumn("key", _key(F.col("epoch")))
    return dealt.withColumn("bucket", F.shiftright("key", 62 - BUCKET_BITS)).drop("whole", "c1")


def mixed(rows: DataFrame, plan: MixPlan) -> DataFrame:
    """``rows`` (grp, n_tokens, base and any others) as often as the plan takes them.

    Adds epoch, block and key; sorted by (block, key) they are the mixed
    stream. Rows that repeat id and text share their key and go together; rows
    without tokens are taken in every whole epoch; null sources are one
    source. An empty table gives no rows.
    """
    return _passes(rows, plan.sources).join(plan.buckets, ["grp", "epoch", "bucket"]).drop("bucket", "weight")
