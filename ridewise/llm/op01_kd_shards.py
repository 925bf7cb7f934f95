"""Shards of near-equal bytes by a k-d tree over document metadata.

Starting from all rows, every node of more than one leaf is split along the
metadata dimension in which it is widest, at the distributed weighted median
(weights are bytes; a node of an odd number of leaves is split in that
proportion), until leaves reach the target bytes. All nodes of a level are
split together. Rows equal in the dimension are split by a hash, so one value
that holds a third of all bytes does no harm.

DataFrame functions only. What the driver sees is a flag a round; the tree is
a table of one row a node.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewise.llm.common import stage, utf8
from ridewise.llm.weighted_cut import TOP, hash_key, weighted_cuts

#: A split may miss its target by this part of a leaf's bytes.
TOLERANCE = 0.0005
#: Rows that one slot bucket holds on average.
BUCKET_ROWS = 20_000


def value_ranks(docs: DataFrame, c: str) -> DataFrame:
    """(c, rank) of the distinct values of a column that are not null, dense from 1 in their order.

    The values are sorted by ranges and numbered within each, so no task holds
    them all: what a window sees is a count a range.
    """
    values = docs.where(F.col(c).isNotNull()).select(c).distinct().orderBy(c)
    placed = stage(values.select(c, F.monotonically_increasing_id().alias("at")), "kd-values")
    # an id is its range's number above 33 bits of place in the range
    placed = placed.select(c, F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return placed.join(parts, "part").select(c, (F.col("base") + F.col("place") + 1).alias("rank"))


def kd_leaves(rows: DataFrame, dims: list[str], n_shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """``rows`` with a column ``shard``: the leaf, from 0, in tree order.

    rows: long columns ``dims`` (no nulls), ``size`` and ``tie`` (a hash in
    [0, TOP] that is the row's own). Give the number of leaves or their bytes.
    """
    span = rows.agg(F.sum("size").alias("bytes"), *(f(d).cast("double").alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max)))).first()
    total = span["bytes"] or 0
    leaves = n_shards or max(1, round(total / target_bytes))
    scale = {d: (span[f"max_{d}"] - span[f"min_{d}"]) or 1.0 for d in dims} if total else {}
    # a node is known by its first leaf; not a literal, on which a join would have no key
    tree = rows.withColumns({"shard": (F.col("tie") * 0).cast("int"), "leaves": F.lit(leaves)})
    for _ in range(math.ceil(math.log2(leaves)) if total and leaves > 1 else 0):
        inner = tree.where("leaves > 1")
        widths = [((F.max(d) - F.min(d)) / F.lit(scale[d])).alias(f"width_{i}") for i, d in enumerate(dims)]
        nodes = inner.groupBy("shard", "leaves").agg(F.sum("size").alias("bytes"), *widths)
        ranked = F.array_max(F.array(*(F.struct(F.col(f"width_{i}").alias("w"), F.lit(-i).alias("i")) for i in range(len(dims)))))
        half = F.floor(F.col("leaves") / 2).cast("int")
        nodes = stage(nodes.select(F.col("shard").alias("grp"), F.negate(ranked["i"]).alias("axis"), half.alias("half"),
                                   (F.col("bytes") * half / F.col("leaves")).alias("target")), "kd-nodes")
        keyed = (inner.join(nodes.select(F.col("grp").alias("shard"), "axis"), "shard")
                 .select(F.col("shard").alias("grp"), F.element_at(F.array(*dims), F.col("axis") + 1).alias("k1"),
                         F.col("tie").alias("k2"), F.col("size").alias("w")))
        cuts = weighted_cuts(keyed, nodes.select("grp", "target"), TOLERANCE * total / leaves)
        step = nodes.join(cuts, "grp").withColumnRenamed("grp", "shard")
        joined = tree.join(step, "shard", "left")
        value = F.element_at(F.array(*dims), F.col("axis") + 1)
        left = (value < F.col("c1")) | ((value == F.col("c1")) & (F.col("tie") <= F.col("c2")))
        tree = stage(joined.select(
            *rows.columns,
            F.when(F.col("half").isNull() | left, F.col("shard")).otherwise(F.col("shard") + F.col("half")).alias("shard"),
            F.when(F.col("half").isNull(), F.col("leaves")).when(left, F.col("half")).otherwise(F.col("leaves") - F.col("half")).alias("leaves")), "kd-level")
    return tree.drop("leaves")


def with_slots(rows: DataFrame, n_rows: int, n_shards: int) -> DataFrame:
    """A gapless ``slot`` from 0 in every shard, in the order of ``tie``.

    A shard is numbered in buckets (the leading bits of ``tie``), so that no
    task holds a whole shard: rows before the bucket, plus the rank in it.
    """
    bits = max(6, math.ceil(math.log2(max(1, n_rows / max(1, n_shards) / BUCKET_ROWS))))
    rows = rows.withColumn("bucket", F.shiftright("tie", 62 - bits))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("tie", "doc_id"))
    return rows.withColumn("rank", rank).join(base, ["shard", "bucket"]).withColumn("slot", F.col("base") + F.col("rank") - 1).drop("rank", "base", "bucket")


def kd_shards(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs``.

    Takes doc_id, text, lang and source; others are ignored. The dimensions
    are size, language, source (as ranks of their distinct values) and id. size is the text's UTF-8 bytes plus 8;
    a null text has none and the checksum of the empty text. Null metadata is
    the least value of its dimension. Repeated rows are rows like others. An
    empty table gives no rows; with fewer rows than shards, some are empty.
    """
    tag = F.monotonically_increasing_id()
    slim = docs.select("doc_id", (F.octet_length(utf8("text")) + F.lit(8)).cast("long").alias("size"), F.crc32(utf8("text")).alias("text_crc32"),
                       F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                       # two bits less, so that differences can't overflow
                       F.coalesce(F.shiftright("doc_id", 2), F.lit(-(1 << 61))).alias("dim_id"), hash_key("doc_id", tag).alias("tie"))
    named = docs.select(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    for c in ("lang", "source"):
        ranks = stage(value_ranks(named, c), "kd-ranks").withColumnRenamed("rank", f"rank_{c}")
        # the planner broadcasts the ranks if their file is small, and deals hot values anew if not
        slim = slim.join(ranks, c, "left").withColumn(f"dim_{c}", F.coalesce(f"rank_{c}", F.lit(0).cast("long"))).drop(f"rank_{c}", c)
    slim = stage(slim, "kd-rows")
    tree = kd_leaves(slim, ["size", "dim_lang", "dim_source", "dim_id"], n_shards, target_bytes)
    n = slim.count()
    return with_slots(tree, n, n_shards or 1).select("doc_id", "size", "text_crc32", "shard", "slot")
