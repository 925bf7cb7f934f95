"""Time-series preparation.

The hourly demand table has one row per (city, date, hour): it grows with
the time span, not with the ride count, so windows over it (lags, rolling
means, per-city positions) are cheap. Ride-level temporal splits never rank
the whole table: they locate the boundary row by counting — per date, then
per minute inside the boundary date, then by ride_id inside the boundary
minute — and compare every ride against that key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewise.functions.lineage import discard, store
from ridewise.operators.features import cyclical

HOURLY_KEYS = ["city", "date", "hour"]
LAG_COLUMNS = ["rides_lag_1d", "rides_lag_7d", "rides_roll_3d", "rides_roll_7d"]
DEMAND_FEATURES = ["hour", "day_of_week", "month", "quarter", "is_peak_hour", "is_weekend",
                   "is_raining", "is_heavy_rain", "is_fog", "is_festival", "is_ipl_day", "season_code",
                   "rides_lag_1d", "rides_lag_7d", "rides_roll_3d", "rides_roll_7d",
                   "hour_sin", "hour_cos", "dow_sin", "dow_cos"]


# G1 -----------------------------------------------------------------------------
def hourly_dataset(enriched: DataFrame) -> DataFrame:
    """Rides per (city, date, hour) with the calendar/weather attributes of the slot.

    Attributes fixed by the key take ``max`` (deterministic, unlike ``first``);
    the rain/fog flags are ``max`` by definition.
    """
    fixed = ["is_peak_hour", "is_weekend", "season_code", "city_code", "month", "day_of_week", "quarter"]
    return (enriched.groupBy(*HOURLY_KEYS).agg(
        F.count(F.lit(1)).alias("rides"),
        *[F.max(c).alias(c) for c in fixed],
        *[F.max(c).alias(c) for c in ("is_raining", "is_heavy_rain", "is_fog")],
        F.max(F.col("is_festival").cast("int")).alias("is_festival"),
        F.max(F.col("is_ipl_day").cast("int")).alias("is_ipl_day"),
    ))


# G2–G4 ---------------------------------------------------------------------------
def lag_features(hourly: DataFrame, drop_incomplete: bool = True) -> DataFrame:
    """Previous / 7th previous observed day at the same (city, hour), and the
    mean of the preceding 3 / 7 observed days (current row excluded).

    Row-based like the reference: a missing day is skipped, not filled.
    One window spec, so one sort of the (small) hourly table.
    """
    w = Window.partitionBy("city", "hour").orderBy("date")
    out = hourly.withColumns({
        "rides_lag_1d": F.lag("rides", 1).over(w).cast("double"),
        "rides_lag_7d": F.lag("rides", 7).over(w).cast("double"),
        "rides_roll_3d": F.avg("rides").over(w.rowsBetween(-3, -1)),
        "rides_roll_7d": F.avg("rides").over(w.rowsBetween(-7, -1)),
    })
    if drop_incomplete:
        out = out.where(F.col("rides_lag_1d").isNotNull() & F.col("rides_lag_7d").isNotNull())
    return out


# G5 -----------------------------------------------------------------------------
def city_dataset(hourly: DataFrame, city: str | None = None) -> DataFrame:
    """Cyclical encodings + lag features; all cities at once unless one is named."""
    src = hourly.where(F.col("city") == city) if city else hourly
    return lag_features(src.withColumns(cyclical()))


# G6 / G11 (hourly, per city) -------------------------------------------------------
def hourly_split(ds: DataFrame, train_frac: float = 0.8) -> DataFrame:
    """Per city: first ⌊frac·n⌋ rows in (date, hour) order are train, the rest test.

    Positions come from a window per city over the hourly table (bounded by
    the number of days × 24 per city).
    """
    w = Window.partitionBy("city").orderBy("date", "hour")
    n = F.count(F.lit(1)).over(Window.partitionBy("city"))
    pos = F.row_number().over(w)
    return (ds.withColumns({"_pos": pos, "_n": n})
              .withColumn("role", F.when(F.col("_pos") <= F.floor(F.col("_n") * train_frac), "train")
                                   .otherwise("test"))
              .withColumn("row_index", F.col("_pos") - 1)
              .drop("_pos", "_n"))


def split_periods(split: DataFrame, key: Sequence[str] = ("city",)) -> DataFrame:
    """first/last date and row count of train and test."""
    return split.groupBy(*key, "role").agg(F.min("date").alias("first_date"),
                                           F.max("date").alias("last_date"),
                                           F.count(F.lit(1)).alias("rows"))


# G7 / G8 (hourly, per city) --------------------------------------------------------
def hourly_folds(train: DataFrame, n_splits: int = 5) -> DataFrame:
    """Expanding-window folds over each city's training rows (TimeSeriesSplit).

    With n rows and size = n div (n_splits+1), fold i (1-based) validates on
    rows [n-(n_splits-i+1)·size, … + size) and trains on everything before.
    Each row gets ``segment`` = the fold it validates (0 = train-only rows).
    """
    w = Window.partitionBy("city").orderBy("date", "hour")
    n = F.count(F.lit(1)).over(Window.partitionBy("city"))
    size = F.floor(n / (n_splits + 1))
    pos = F.row_number().over(w) - 1
    first = n - size * n_splits
    seg = F.when(pos < first, F.lit(0)).otherwise(F.floor((pos - first) / size) + 1).cast("int")
    return train.withColumn("segment", seg)


def fold_sizes(folded: DataFrame, n_splits: int = 5, key: Sequence[str] = ("city",)) -> DataFrame:
    """Train / validation size of each fold from per-segment counts."""
    seg = folded.groupBy(*key, "segment").agg(F.count(F.lit(1)).alias("n"))
    # each (≤ #cities × 6) segment count is repeated once per fold
    j = seg.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(n_splits))))
    return (j.groupBy(*key, "fold").agg(
        F.sum(F.when(F.col("segment") < F.col("fold"), F.col("n")).otherwise(0)).alias("train_size"),
        F.sum(F.when(F.col("segment") == F.col("fold"), F.col("n")).otherwise(0)).alias("val_size")))


# G10 ----------------------------------------------------------------------------
def last_n_at_hour(split: DataFrame, hour: int = 18, n: int = 30) -> DataFrame:
    """Last n test rows at one hour, per city (window over the small hourly table)."""
    w = Window.partitionBy("city").orderBy(F.desc("date"))
    return (split.where((F.col("role") == "test") & (F.col("hour") == hour))
                 .withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r"))


# G6 / G7 / G9 (ride level) ---------------------------------------------------------
def order_by_time(df: DataFrame) -> DataFrame:
    """Rides in time order (ride_id breaks ties) — a range-partitioned sort."""
    return df.orderBy("ts", "ride_id")


def _boundary_keys(df: DataFrame, positions: Sequence[int]) -> list[tuple]:
    """(ts, ride_id) of the rows at the given 0-based positions in (ts, ride_id) order.

    Counting, not ranking: per-day counts (one row per day) locate the day of
    each position; counts per minute, second and instant inside it locate the
    instant; counts per ride_id prefix the ride. Each step
    hands a bounded handful of values (≤ one per position) to the next as
    literal range / equality filters. The boundary days' keys are stored once,
    and the steps inside a day read that copy instead of the whole table.
    Returns one key per position (None past the end).
    """
    import datetime as _dt

    spark = df.sparkSession
    pos = [(i, int(p)) for i, p in enumerate(positions)]
    d = df.select("ts", "ride_id")
    daily = d.groupBy(F.to_date("ts").alias("_d")).agg(F.count(F.lit(1)).alias("c"))
    daily = daily.withColumn("cb", F.coalesce(F.sum("c").over(Window.orderBy("_d").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)))                      # one row per day
    pdf = spark.createDataFrame(pos, "pid int, p long")
    at_day = (F.broadcast(pdf).join(daily, (F.col("p") >= F.col("cb")) & (F.col("p") < F.col("cb") + F.col("c")))
              .select("pid", "_d", (F.col("p") - F.col("cb")).alias("k1")).collect())       # ≤ len(positions)
    if not at_day:
        return [None] * len(positions)
    days = sorted({r["_d"] for r in at_day})
    in_days = None
    for day in days:
        lo = _dt.datetime.combine(day, _dt.time())
        cond = (F.col("ts") >= F.lit(lo)) & (F.col("ts") < F.lit(lo + _dt.timedelta(days=1)))
        in_days = cond if in_days is None else in_days | cond
    # day -> minute -> second -> instant: each level counts inside the units
    # chosen before it (at most 1440, 60 and one second's instants a position)
    found = {r["pid"]: (r["_d"], r["k1"]) for r in at_day}
    d, copy = store(d.where(in_days), "boundary-days")
    inside = d.withColumn("_u", F.to_date("ts").cast("timestamp_ntz"))
    for unit in ("minute", "second", None):
        finer = F.date_trunc(unit, "ts").cast("timestamp_ntz") if unit else F.col("ts")
        counts = inside.withColumn("_f", finer).groupBy("_u", "_f").agg(F.count(F.lit(1)).alias("c"))
        upto = Window.partitionBy("_u").orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("cb", F.coalesce(F.sum("c").over(upto), F.lit(0)))
        ask = spark.createDataFrame([(i, u, k) for i, (u, k) in found.items()], "pid int, _a timestamp_ntz, k long") \
            if unit != "minute" else spark.createDataFrame(
                [(i, _dt.datetime.combine(u, _dt.time()), k) for i, (u, k) in found.items()], "pid int, _a timestamp_ntz, k long")
        hits = (F.broadcast(ask).join(counts, (F.col("_a") == F.col("_u")) & (F.col("k") >= F.col("cb")) & (F.col("k") < F.col("cb") + F.col("c")))
                .select("pid", "_f", (F.col("k") - F.col("cb")).alias("k")).collect())          # ≤ len(positions)
        found = {r["pid"]: (r["_f"], r["k"]) for r in hits}
        units = sorted({u for u, _ in found.values()})
        inside = inside.withColumn("_u", finer).where(F.col("_u").isin(units))
    keys = {i: (u, _kth_ride_id(d.where(F.col("ts") == F.lit(u)), k)) for i, (u, k) in found.items()}
    discard(spark, copy)
    return [keys.get(i) for i in range(len(positions))]


def _kth_ride_id(rows: DataFrame, k: int, step: int = 2) -> str:
    """The k-th smallest ride_id (0-based) among ``rows``, by counting only.

    Rides are counted per ride_id prefix, two more characters a round, until
    the prefix that holds the k-th id holds one distinct id. A round gives one
    row per distinct continuation; nothing is ranked, whatever the group's size.
    """
    prefix = ""
    while True:
        level = len(prefix) + step
        group = rows.where(F.col("ride_id").startswith(prefix)) if prefix else rows
        counts = (group.groupBy(F.substring("ride_id", 1, level).alias("p"))
                       .agg(F.count(F.lit(1)).alias("c"), F.min("ride_id").alias("lo"), F.max("ride_id").alias("hi"))
                       .orderBy("p").collect())
        for row in counts:
            if k < row["c"]:
                break
            k -= row["c"]
        if row["lo"] == row["hi"]:
            return row["lo"]
        prefix = row["p"]


def _before(key: tuple | None) -> Column:
    """Row strictly before ``key`` in (ts, ride_id) order (None = past the end)."""
    if key is None:
        return F.lit(True)
    ts, rid = key
    return (F.col("ts") < F.lit(ts)) | ((F.col("ts") == F.lit(ts)) & (F.col("ride_id") < F.lit(rid)))


def temporal_split(df: DataFrame, train_frac: float = 0.8) -> DataFrame:
    """G6 on rides: the first ⌊frac·n⌋ rides in time order are train, the rest test."""
    n = df.count()
    (key,) = _boundary_keys(df, [math.floor(n * train_frac)])
    return df.withColumn("role", F.when(_before(key), "train").otherwise("test"))


def time_series_folds(df: DataFrame, n_splits: int = 5) -> DataFrame:
    """G7 on rides: ``segment`` = validation fold of each ride (0 = train-only)."""
    n = df.count()
    size = n // (n_splits + 1)
    starts = [n - (n_splits - i) * size for i in range(n_splits)]
    keys = _boundary_keys(df, starts)
    seg = F.lit(0)
    for k in keys:
        seg = seg + F.when(_before(k), 0).otherwise(1)
    return df.withColumn("segment", seg.cast("int"))
