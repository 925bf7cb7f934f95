"""Distributed weighted quantiles by histogram refinement, one a group.

Native throughout: a round is one aggregate over (group, bin) with map-side
sums, at most ``BINS`` rows a group, and a window over those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridewise.llm.common import stage

BINS = 1024
#: Keys must lie in [0, TOP]; hashes are brought there by ``hash_key``.
TOP = (1 << 62) - 1


def hash_key(*cols):
    """A hash in [0, TOP]."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 2)


def weighted_cuts(rows: DataFrame, targets: DataFrame, tolerance: float) -> DataFrame:
    """(grp, c1, c2) such that the rows of grp with (k1, k2) <= (c1, c2) weigh about ``target``.

    rows: (grp, k1, k2, w); k1, k2 longs whose span in a group is under 2**62,
    w >= 0. targets: (grp, target). Keys are compared k1 first. A group's
    range is narrowed to the bin that holds the target until one key is left
    or the bin weighs at most ``tolerance``; the cut then goes to the nearer
    side of it. Equal keys stay together. Groups without rows are left out.
    """
    state = stage(rows.join(targets, "grp").groupBy("grp", "target").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi"))
                  .select("grp", "target", "lo", "hi", F.lit(None).cast("long").alias("k1_is"),
                          F.lit(0.0).alias("before"), F.lit(0.0).alias("weight"), F.lit(False).alias("done")), "cut")
    while state.where("not done").limit(1).count():
        part = F.when(F.col("k1_is").isNull(), F.col("k1")).otherwise(F.col("k2"))
        width = F.floor((F.col("hi") - F.col("lo")) / F.lit(BINS)) + 1
        seen = (rows.join(state.where("not done"), "grp")
                .where((F.col("k1_is").isNull() | (F.col("k1") == F.col("k1_is"))) & part.between(F.col("lo"), F.col("hi")))
                .select("grp", "w", part.alias("part"), F.floor((part - F.col("lo")) / width).alias("bin")))
        bins = seen.groupBy("grp", "bin").agg(F.sum(F.col("w").cast("double")).alias("bw"), F.min("part").alias("b_lo"), F.max("part").alias("b_hi"))
        upto = Window.partitionBy("grp").orderBy("bin")
        bins = bins.select("*", F.sum("bw").over(upto).alias("cum"), F.lead("bin").over(upto).isNull().alias("last")).join(state.where("not done"), "grp")
        hit = bins.where((F.col("before") + F.col("cum") >= F.col("target")) | F.col("last"))
        pick = hit.groupBy("grp").agg(F.min_by(F.struct("target", "b_lo", "b_hi", "k1_is", (F.col("before") + F.col("cum") - F.col("bw")).alias("before"), "bw"), "bin").alias("b")).select("grp", "b.*")
        one, first = F.col("b_lo") == F.col("b_hi"), F.col("k1_is").isNull()
        light = F.col("bw") <= F.lit(float(tolerance))
        tie = one & first & ~light                     # go on among equal k1
        moved = pick.select(
            "grp", "target",
            F.when(tie, F.lit(0)).otherwise(F.col("b_lo")).alias("lo"), F.when(tie, F.lit(TOP)).otherwise(F.col("b_hi")).alias("hi"),
            F.when(tie, F.col("b_lo")).otherwise(F.col("k1_is")).alias("k1_is"), "before", F.col("bw").alias("weight"),
            (light | (one & ~first)).alias("done"))
        state = stage(state.where("done").unionByName(moved), "cut")
    inside = F.col("before") + F.col("weight") / 2 <= F.col("target")
    edge = F.when(inside, F.col("hi")).otherwise(F.col("lo") - 1)
    return state.select("grp", F.coalesce("k1_is", edge).alias("c1"), F.when(F.col("k1_is").isNull(), F.lit(TOP)).otherwise(edge).alias("c2"))
