"""Fleet rebalancing (I1–I4): surge risk by city × hour and the top priorities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewise.functions.columns import round_np
from ridewise.functions.joins import proven_broadcast

HOURS = list(range(24))


def surge_risk_matrix(scored: DataFrame, prob: str = "surge_prob", key: str = "city_code") -> DataFrame:
    """Mean surge probability per (key, hour) as a key × 24 matrix, missing → 0.

    A grouped aggregate with conditional averages — partial aggregation, one
    output row per key.
    """
    aggs = [F.coalesce(F.avg(F.when(F.col("hour") == h, F.col(prob))), F.lit(0.0)).alias(f"h{h:02d}")
            for h in HOURS]
    return scored.groupBy(key).agg(*aggs)


def unpivot_matrix(matrix: DataFrame, key: str = "city_code", value: str = "surge_prob") -> DataFrame:
    """Key × hour matrix → (key, hour, value) rows."""
    long = matrix.unpivot(key, [f"h{h:02d}" for h in HOURS], "_h", value)
    return long.select(key, F.substring("_h", 2, 2).cast("int").alias("hour"), value)


def decode_city(df: DataFrame, codes: DataFrame, key: str = "city_code") -> DataFrame:
    """I4: city code → name through the (≤ #cities rows) code table."""
    return df.join(proven_broadcast(codes.select(F.col("city"), F.col(key))), key, "left")


def rebalancing_top(long: DataFrame, k: int = 10, value: str = "surge_prob") -> DataFrame:
    """The k (city, hour) cells with the highest risk, labelled 'City h:00'."""
    top = long.orderBy(F.desc(value), "city", "hour").limit(k)
    return top.withColumn("label", F.concat(F.col("city"), F.lit(" "), F.col("hour").cast("string"), F.lit(":00")))


def rounded(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    return df.withColumns({c: round_np(c, digits) for c in cols})
