"""Exact grouped quantiles by histogram refinement and counting.

``percentile`` keeps every distinct value of a group in one buffer. Here a
group's range is cut into bins, map-side sums count the rows of each bin, and
the bin that holds a wanted rank becomes the next range, until it holds one
value. A round moves at most ``BINS`` rows a range and task; no task holds a
group's values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ridewise.functions.joins import proven_broadcast
from ridewise.functions.lineage import cut_lineage

BINS = 4096
#: Ranges and ranks of up to this many rows stay in the plan as values; more are stored.
LOCAL_ROWS = 10_000


def _settled(df: DataFrame) -> tuple[DataFrame, list[Row] | None]:
    """``df`` computed: its rows as values if they are few, else a stored copy."""
    rows = df.limit(LOCAL_ROWS + 1).collect()
    if len(rows) <= LOCAL_ROWS:
        return df.sparkSession.createDataFrame(rows, df.schema), rows
    return cut_lineage(df, "quantile-ranges"), None


def _cells(state: DataFrame, rows: list[Row] | None, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(ranges to cut, with a number; open ranks with the number of their range)."""
    names = [*keys, "lo", "hi"]
    open_ = state.where("lo < hi")
    if rows is None:
        cells = cut_lineage(open_.select(*names).distinct().withColumn("_cell", F.monotonically_increasing_id()), "quantile-cells")
        same = _same(open_, cells, names)
        return cells, open_.join(cells, same).select(*(open_[c] for c in open_.columns), "_cell")
    spark, number, ranks = state.sparkSession, {}, []
    for r in rows:
        if r["lo"] < r["hi"]:
            cell = number.setdefault(tuple(r[n] for n in names), len(number))
            ranks.append((*r, cell))
    fields = {f.name: f for f in state.schema}
    schema = StructType([*(fields[n] for n in names), StructField("_cell", LongType())])
    return (spark.createDataFrame([(*k, n) for k, n in number.items()], schema),
            spark.createDataFrame(ranks, StructType([*state.schema, StructField("_cell", LongType())])))


def _same(a: DataFrame, b: DataFrame, names: Sequence[str]) -> Column:
    """Equal names, nulls too; plain equality, which hashes numbers faster, where there is no null."""
    return reduce(and_, (a[n].eqNullSafe(b[n]) if a.schema[n].nullable else a[n] == b[n] for n in names), F.lit(True))


def exact_quantiles(rows: DataFrame, keys: Sequence[str], probs: Sequence[float], value: str = "v",
                    weight: str | None = None) -> DataFrame:
    """(keys, prob, quantile, n): interpolated quantiles of ``value`` in each group, as ``percentile`` gives them.

    A row counts ``weight`` times (a whole number; default once). Null, NaN and
    infinite values take no part; a group without values has no row; null keys
    are a group. ``rows`` is scanned once for the ranges and once a round
    (two rounds settle values of up to 16 million steps), with the range as a
    filter. A round's ranges are known before the next one, so this runs jobs.
    """
    keys = list(keys)
    v = F.col(value).cast("double")
    rows = rows.select(*keys, v.alias("_v"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("_w")).where("abs(_v) < double('Infinity') and _w > 0")
    total = rows.groupBy(*keys).agg(F.sum("_w").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    place = F.col("prob") * (F.col("n") - 1)
    total = total.withColumn("prob", F.explode(F.array(*(F.lit(float(p)) for p in probs))))
    total, known = _settled(total.select(*keys, "n", "lo", "hi", "prob", place.alias("place")))
    wanted = total.select(*keys, "lo", "hi", F.explode(F.array(F.floor("place"), F.ceil("place"))).alias("rank")).distinct()
    state = wanted.select(*keys, "rank", "lo", "hi", F.lit(0).cast("long").alias("before"))
    while True:
        state, known = _settled(state)
        open_now = state.where("lo < hi").limit(1).count() if known is None else any(r["lo"] < r["hi"] for r in known)
        if not open_now:
            break
        cells, ranks = _cells(state, known, keys)
        cells = cells.select(*keys, F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "_cell")
        if known is not None:                          # at most LOCAL_ROWS rows
            cells, ranks = proven_broadcast(cells), proven_broadcast(ranks)
        v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
        # of the widest ranges halves, whose difference is finite
        part = F.when(hi - lo < float("inf"), (v - lo) / (hi - lo)).otherwise((v / 2 - lo / 2) / (hi / 2 - lo / 2))
        bin_ = F.least(F.floor(part * BINS), F.lit(BINS - 1)).cast("int")
        bins = (rows.join(cells, _same(rows, cells, keys) & (v >= lo) & (v <= hi))
                .groupBy("_cell", bin_.alias("_bin")).agg(F.sum("_w").alias("_in"), F.min("_v").alias("_least"), F.max("_v").alias("_most")))
        bins = bins.withColumn("_upto", F.sum("_in").over(Window.partitionBy("_cell").orderBy("_bin")))
        at = F.col("rank") - F.col("before")
        narrowed = ranks.join(bins, "_cell").where((at < F.col("_upto")) & (at >= F.col("_upto") - F.col("_in"))).select(
            *keys, "rank", F.col("_least").alias("lo"), F.col("_most").alias("hi"), (F.col("before") + F.col("_upto") - F.col("_in")).alias("before"))
        state = state.where("lo >= hi").unionByName(narrowed)
    low, high = (state.select(*keys, "rank", F.col("lo").alias(f"_{n}")) for n in ("low", "high"))
    out = total.join(low, _same(total, low, keys) & (F.floor(total["place"]) == low["rank"])).select(*(total[k] for k in keys), "prob", "n", "place", "_low")
    out = out.join(high, _same(out, high, keys) & (F.ceil(out["place"]) == high["rank"])).select(*(out[k] for k in keys), "prob", "n", "place", "_low", "_high")
    between = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(
        (F.ceil("place") - F.col("place")) * F.col("_low") + (F.col("place") - F.floor("place")) * F.col("_high"))
    return _settled(out.select(*keys, "prob", between.alias("quantile"), "n"))[0]


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> Column:
    """Map from '<column>|<prob>' to the exact quantile over all rows, as one scalar value.

    One row a value, so that the columns share the passes.
    """
    items = F.array(*(F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)))
    q = exact_quantiles(df.select(F.inline(items)), ["_c"], probs)
    name = F.get(F.array(*map(F.lit, columns)), F.col("_c"))
    pair = F.struct(F.concat_ws("|", name, F.col("prob").cast("string")), F.col("quantile"))
    return q.agg(F.map_from_entries(F.collect_list(pair))).scalar()        # columns x probs entries
