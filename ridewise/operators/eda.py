"""Exploratory group-by analytics.

Every query groups by low-cardinality keys (hour, city, weather, season,
band, zone), so each is a partial aggregation: the fact table is scanned
once, only per-partition partial states cross the shuffle. Exact medians
use ``percentile``/``median`` (per-group value counts — small for the
discrete wait, surge, rating and fare values); pass ``approx=True`` to
switch to ``percentile_approx`` on unbounded value domains.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewise import config as C
from ridewise.functions.columns import flag, ordinal, pct, round_np
from ridewise.operators.features import event_type, year_month


def _median(c: str, approx: bool = False) -> Column:
    return F.percentile_approx(c, 0.5, 10000) if approx else F.median(c)


def _share(c: Column) -> Column:
    """mean of a 0/1 or boolean column."""
    return F.avg(c.cast("double"))


# F1 ---------------------------------------------------------------------------
def hourly_demand(df: DataFrame) -> DataFrame:
    return (df.groupBy("hour").agg(F.count(F.lit(1)).alias("rides"))
              .withColumn("is_peak", flag(F.col("hour").isin(C.PEAK_HOURS))))


# F2 ---------------------------------------------------------------------------
def hourly_by_city(df: DataFrame, cities: Sequence[str] | None = None) -> DataFrame:
    sel = list(cities or C.VALID_CITIES)
    return (df.filter(F.col("city").isin(sel))
              .groupBy("hour", "city").agg(F.count(F.lit(1)).alias("rides")))


# F3 ---------------------------------------------------------------------------
def peak_dead_share(df: DataFrame) -> DataFrame:
    h = F.col("hour")
    return df.agg(
        round_np(F.count(F.when(h.isin(C.PEAK_HOURS), 1)) * 100.0 / F.count(F.lit(1)), 4).alias("peak_pct"),
        round_np(F.count(F.when(h.isin(C.DEAD_HOURS), 1)) * 100.0 / F.count(F.lit(1)), 4).alias("dead_pct"),
        F.count(F.when(h == 18, 1)).alias("rides_at_18"),
    )


# F4 ---------------------------------------------------------------------------
def busiest_hour(df: DataFrame) -> DataFrame:
    """Busiest hour overall (ties → earliest hour) and the largest (hour, city) cell."""
    by_hour = df.groupBy("hour").agg(F.count(F.lit(1)).alias("rides"))
    cells = df.groupBy("hour", "city").agg(F.count(F.lit(1)).alias("n"))
    return (by_hour.orderBy(F.desc("rides"), "hour").limit(1)
                   .select(F.col("hour").alias("busiest_hour"), "rides",
                           cells.agg(F.max("n")).scalar().alias("max_city_hour_rides")))


# F5 ---------------------------------------------------------------------------
def city_stats(df: DataFrame, approx: bool = False) -> DataFrame:
    return (df.groupBy("city").agg(
                F.count(F.lit(1)).alias("rides"),
                round_np(_median("wait_time_min", approx), 2).alias("median_wait"),
                round_np(_median("fare_inr", approx), 2).alias("median_fare"),
                round_np(F.avg("surge_multiplier"), 2).alias("mean_surge"),
                round_np(round_np(_share(F.col("is_completed")), 2) * 100, 1).alias("completion_rate")))


# F6 ---------------------------------------------------------------------------
def _metric(column: str, how: str, approx: bool = False) -> Column:
    if how == "median":
        return _median(column, approx)
    mean = F.avg(F.col(column).cast("double"))
    return {"mean": mean, "missing_pct": (1 - mean) * 100}[how]


def city_metric(df: DataFrame, column: str = "wait_time_min", how: str = "median", approx: bool = False) -> DataFrame:
    """The column's median, mean or (for a flag) ``missing_pct``, 100 x (1 - mean), by city, greatest first."""
    return (df.groupBy("city").agg(round_np(_metric(column, how, approx), 4).alias("value"))
              .orderBy(F.desc("value"), "city"))


# F7 ---------------------------------------------------------------------------
def city_share(df: DataFrame) -> DataFrame:
    counts = df.groupBy("city").agg(F.count(F.lit(1)).alias("rides"))
    total = F.sum("rides").over(Window.partitionBy())   # ≤ a handful of rows
    return counts.withColumn("share_pct", round_np(F.col("rides") * 100.0 / total, 2))


# F8 ---------------------------------------------------------------------------
def weather_stats(df: DataFrame, approx: bool = False) -> DataFrame:
    return df.groupBy("weather").agg(
        F.count(F.lit(1)).alias("rides"),
        round_np(_median("wait_time_min", approx), 2).alias("median_wait"),
        round_np(F.avg("surge_multiplier"), 2).alias("mean_surge"),
        round_np((1 - _share(F.col("is_completed"))) * 100, 1).alias("cancel_rate"))


# F9 ---------------------------------------------------------------------------
def weather_metric(df: DataFrame, column: str = "wait_time_min", how: str = "median", approx: bool = False) -> DataFrame:
    """As ``city_metric`` by weather, in the order of the weather domain."""
    return (df.groupBy("weather").agg(round_np(_metric(column, how, approx), 4).alias("value"))
              .withColumn("weather_order", ordinal("weather", C.WEATHER_ORDER))
              .orderBy("weather_order"))


# F10 --------------------------------------------------------------------------
def weather_lift(df: DataFrame, base: str = "clear", other: str = "heavy_rain") -> DataFrame:
    """% change of each weather metric from ``base`` to ``other`` weather."""
    per = weather_metrics_long(df)
    return (per.groupBy("metric").agg(
                F.max(F.when(F.col("weather") == base, F.col("value"))).alias("base_value"),
                F.max(F.when(F.col("weather") == other, F.col("value"))).alias("other_value"))
              .withColumn("lift_pct", round_np(pct(F.col("other_value"), F.col("base_value")) * 100 - 100, 2)))


def weather_metrics_long(df: DataFrame) -> DataFrame:
    wide = df.groupBy("weather").agg(
        round_np(F.median("wait_time_min"), 4).alias("median_wait"),
        round_np(F.avg("surge_multiplier"), 4).alias("mean_surge"),
        round_np((1 - _share(F.col("is_completed"))) * 100, 4).alias("cancel_rate"))
    return wide.unpivot("weather", ["median_wait", "mean_surge", "cancel_rate"], "metric", "value")


# F11 --------------------------------------------------------------------------
def weather_wait_sorted(df: DataFrame) -> DataFrame:
    """Median wait by weather, descending (raw table: null weather dropped)."""
    return (df.where(F.col("weather").isNotNull())
              .groupBy("weather").agg(F.median("wait_time_min").alias("median_wait"))
              .orderBy(F.desc("median_wait"), "weather"))


# F12 --------------------------------------------------------------------------
def monthly_trend(df: DataFrame) -> DataFrame:
    return (df.groupBy(year_month().alias("year_month")).agg(
                F.count(F.lit(1)).alias("rides"),
                round_np(F.avg("surge_multiplier"), 4).alias("mean_surge"),
                round_np(F.avg("wait_time_min"), 4).alias("mean_wait"))
              .orderBy("year_month"))


# F13 --------------------------------------------------------------------------
def season_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("season").agg(
        F.count(F.lit(1)).alias("rides"),
        round_np(F.avg("surge_multiplier"), 3).alias("mean_surge"),
        round_np(F.avg("wait_time_min"), 3).alias("mean_wait"),
        round_np(round_np(_share(F.col("is_raining")), 3) * 100, 1).alias("rain_pct"))


# F14 --------------------------------------------------------------------------
def festival_effect(df: DataFrame) -> DataFrame:
    """By festival flag: mean wait, surge, fare and ride count (round 2)."""
    return (df.groupBy("is_festival").agg(
                round_np(F.avg("wait_time_min"), 2).alias("avg_wait"),
                round_np(F.avg("surge_multiplier"), 2).alias("avg_surge"),
                round_np(F.avg("fare_inr"), 2).alias("avg_fare"),
                F.count("ride_id").alias("ride_count"))
              .withColumn("day_type", F.when(F.col("is_festival"), "Festival day").otherwise("Normal day")))


# F15 --------------------------------------------------------------------------
def event_impact(df: DataFrame, metric: str = "wait_time_min") -> DataFrame:
    return (df.groupBy(event_type().alias("event_type"))
              .agg(round_np(F.avg(metric), 4).alias("mean_value"))
              .withColumn("event_order", ordinal("event_type", C.EVENT_ORDER))
              .orderBy("event_order"))


# F16 --------------------------------------------------------------------------
def event_lift(df: DataFrame) -> DataFrame:
    """% difference festival vs normal day for wait, surge and fare means."""
    e = event_type()
    metrics = ["wait_time_min", "surge_multiplier", "fare_inr"]
    aggs = []
    for m in metrics:
        aggs += [F.avg(F.when(e == "Normal day", F.col(m))).alias(f"{m}__n"),
                 F.avg(F.when(e == "Festival day", F.col(m))).alias(f"{m}__f")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(m).alias("metric"),
                     round_np(F.col(f"{m}__n"), 4).alias("normal_value"),
                     round_np(F.col(f"{m}__f"), 4).alias("festival_value"),
                     round_np((pct(F.col(f"{m}__f"), F.col(f"{m}__n")) - 1) * 100, 2).alias("lift_pct"))
            for m in metrics]
    return wide.select(F.inline(F.array(*rows)))


# F17 --------------------------------------------------------------------------
def vehicle_metric(df: DataFrame, approx: bool = False) -> DataFrame:
    return (df.groupBy("vehicle_type").agg(
                round_np(_median("fare_per_km", approx), 4).alias("median_fare_per_km"),
                round_np(_median("wait_time_min", approx), 4).alias("median_wait"),
                round_np(_median("fare_inr", approx), 4).alias("median_fare"),
                round_np(_median("distance_km", approx), 4).alias("median_distance"))
              .orderBy(F.desc("median_fare_per_km"), "vehicle_type"))


# F18 --------------------------------------------------------------------------
def surge_band_by_city(df: DataFrame) -> DataFrame:
    return (df.groupBy("city", "surge_band").agg(F.count(F.lit(1)).alias("rides"))
              .withColumn("band_order", ordinal("surge_band", C.SURGE_BAND_LABELS)))


# F19 --------------------------------------------------------------------------
def surge_band_pct(df: DataFrame) -> DataFrame:
    counts = df.groupBy("city", "surge_band").agg(F.count(F.lit(1)).alias("rides"))
    # the window runs on the ≤ cities × bands aggregate, never on rides
    city_total = F.sum("rides").over(Window.partitionBy("city"))
    return counts.withColumn("pct", round_np(F.col("rides") * 100.0 / city_total, 2))


# F20 / F21 ----------------------------------------------------------------------
HOURS = list(range(24))


def _hour_pivot(df: DataFrame, row_key: str) -> DataFrame:
    """row_key × 24 hours of counts; missing cells are 0."""
    aggs = [F.count(F.when(F.col("hour") == h, 1)).alias(f"h{h:02d}") for h in HOURS]
    return df.groupBy(row_key).agg(*aggs)


def city_hour_heatmap(df: DataFrame) -> DataFrame:
    """city × hour counts plus the min/max over all cells (colour scale)."""
    wide = _hour_pivot(df, "city")
    cells = [F.col(f"h{h:02d}") for h in HOURS]
    lo = F.min(F.least(*cells)).over(Window.partitionBy())    # over ≤ #cities rows
    hi = F.max(F.greatest(*cells)).over(Window.partitionBy())
    return wide.withColumns({"cell_min": lo, "cell_max": hi})


def hour_dow_heatmap(df: DataFrame) -> DataFrame:
    """day-of-week × hour counts."""
    return _hour_pivot(df, "day_of_week")


# F22 / F23 ----------------------------------------------------------------------
# fixed values: the column lists
CORR_12 = ["wait_time_min", "surge_multiplier", "fare_inr", "distance_km",
           "driver_rating", "demand_pressure", "is_peak_hour", "is_raining",
           "is_festival", "is_ipl_day", "is_high_surge", "hourly_ride_volume"]
CORR_TARGET_9 = ["wait_time_min", "surge_multiplier", "distance_km", "fare_inr",
                 "is_peak_hour", "is_raining", "is_festival", "is_ipl_day", "demand_pressure"]


def _corr_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r for every unordered pair, in long form (both orders), pairwise complete.

    Each Arrow batch gives one Gram matrix of (present, x, x²) per column,
    nulls counting as zero: its entries are every pair's count, sums and sums
    of products over the rows where both are present. Spark adds the matrices;
    a partition sends one, (3k)² numbers. Values are taken less the column's
    mean, so that sums of squares lose no digits.
    """
    import numpy as np
    import pandas as pd

    cols = list(columns)
    # NaN is a missing value here, as in pandas
    num = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    means = num.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in cols]).first()
    centre, k = np.array([means[c] for c in cols]), len(cols)

    def grams(batches):
        total = np.zeros((3 * k, 3 * k))
        for batch in batches:
            x = batch.to_numpy(dtype=np.float64) - centre
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            wide = np.hstack([there.astype(np.float64), x, x * x])
            total += wide.T @ wide
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

    entry = num.mapInPandas(grams, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    part = (entry.withColumn("what", F.concat(F.floor(F.col("i") / k).cast("string"), F.floor(F.col("j") / k).cast("string")))
            .withColumn("a", F.col("i") % k).withColumn("b", F.col("j") % k).where("a <> b")
            .groupBy("a", "b").pivot("what", ["00", "10", "01", "11", "20", "02"]).agg(F.first("v")))
    n, sx, sy, sxy, sxx, syy = (F.col(f"`{w}`") for w in ("00", "10", "01", "11", "20", "02"))
    vx, vy = sxx - sx * sx / n, syy - sy * sy / n
    r = F.when((n > 1) & (vx > 0) & (vy > 0), (sxy - sx * sy / n) / F.sqrt(vx * vy))
    names = F.array(*map(F.lit, cols))
    return part.select(F.get(names, F.col("a")).alias("col_a"), F.get(names, F.col("b")).alias("col_b"), r.alias("r"))


def corr_raw(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """r of every pair of raw columns, nulls and all, round 4."""
    return _corr_pairs(df, columns).select("col_a", "col_b", round_np("r", 4).alias("r"))


def corr_matrix_12(df: DataFrame) -> DataFrame:
    """Pearson matrix of 12 columns (long form, diagonal included), round 2."""
    off = _corr_pairs(df, CORR_12).withColumn("r", round_np("r", 2))
    diag = df.sparkSession.createDataFrame([(c, c, 1.0) for c in CORR_12], "col_a string, col_b string, r double")
    return off.unionByName(diag)


def corr_with_target(df: DataFrame) -> DataFrame:
    """r of 8 features with fare and with wait, self dropped, round 3, sorted desc."""
    long = _corr_pairs(df, CORR_TARGET_9)
    return (long.where(F.col("col_a").isin("fare_inr", "wait_time_min"))
                .select(F.col("col_a").alias("target"), F.col("col_b").alias("feature"),
                        round_np("r", 3).alias("r"))
                .orderBy("target", F.desc("r"), "feature"))


# F24 --------------------------------------------------------------------------
def zone_hotspots(df: DataFrame, k: int = 10) -> DataFrame:
    """Top-k zones by mean wait with surge badge (≥1.6 red, ≥1.55 amber)."""
    z = (df.groupBy("pickup_zone", "city").agg(
            round_np(F.avg("wait_time_min"), 4).alias("avg_wait"),
            round_np(F.avg("surge_multiplier"), 4).alias("mean_surge"),
            F.count(F.lit(1)).alias("rides")))
    top = z.orderBy(F.desc("avg_wait"), "pickup_zone", "city").limit(k)
    s = F.col("mean_surge")
    return top.withColumn("badge", F.when(s >= 1.6, "red").when(s >= 1.55, "amber").otherwise("green"))


# F25 / F26 ----------------------------------------------------------------------
def _kpis(approx: bool = False) -> list[Column]:
    return [F.count(F.lit(1)).alias("rides"),
            round_np(_median("wait_time_min", approx), 4).alias("median_wait"),
            round_np(F.avg("surge_multiplier"), 4).alias("mean_surge"),
            round_np((1 - _share(F.col("is_completed"))) * 100, 4).alias("cancel_pct"),
            round_np(_median("fare_inr", approx), 4).alias("median_fare")]


def kpi_cards(df: DataFrame, cities: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """KPI tiles for all rides and for each city, in one rollup pass."""
    src = df.filter(F.col("city").isin(list(cities))) if cities else df
    return (src.rollup("city").agg(*_kpis(approx), F.grouping("city").cast("int").alias("is_total")))


def kpi_by_weather(df: DataFrame, approx: bool = False) -> DataFrame:
    return (df.rollup("weather").agg(
        round_np(_median("wait_time_min", approx), 4).alias("median_wait"),
        round_np(F.avg("surge_multiplier"), 4).alias("mean_surge"),
        F.grouping("weather").cast("int").alias("is_total")))


# F27 --------------------------------------------------------------------------
def surge_histogram(df: DataFrame, bins: int = 30, column: str = "surge_multiplier") -> DataFrame:
    """Equal-width histogram between min and max (last bin closed), zero bins kept.

    min and max are scalar subqueries (computed once, inlined as values).
    """
    x = F.col(column)
    least, most = df.agg(F.min(x)).scalar(), df.agg(F.max(x)).scalar()
    # a zero range is widened by half a unit on each side
    pad = F.when(least == most, F.lit(0.5)).otherwise(F.lit(0.0))
    lo, hi = least - pad, most + pad
    width = (hi - lo) / F.lit(float(bins))
    b = F.least(F.floor((x - lo) / width).cast("int") + 1, F.lit(bins))
    counts = (df.where(x.isNotNull())
                .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("rides")))
    grid = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
                .select("bin",
                        round_np(lo + (F.col("bin") - 1) * width, 6).alias("bin_lo"),
                        round_np(lo + F.col("bin") * width, 6).alias("bin_hi"),
                        F.coalesce("rides", F.lit(0)).cast("long").alias("rides")))


# F28 --------------------------------------------------------------------------
def high_surge_share(df: DataFrame) -> DataFrame:
    hs = F.col("surge_multiplier") >= C.HIGH_SURGE_THRESHOLD
    return df.agg(F.count(F.when(hs, 1)).alias("high_surge_rides"),
                  round_np(_share(hs) * 100, 4).alias("high_surge_pct"))


# F29 --------------------------------------------------------------------------
def head_sample(df: DataFrame, n: int = 3) -> DataFrame:
    """First n rides in time order (ride_id breaks ties) — a top-n, not a scan."""
    return df.orderBy("ts", "ride_id").limit(n)


# F30 --------------------------------------------------------------------------
def ratio_to_max(agg: DataFrame, value: str, out: str = "ratio_to_max") -> DataFrame:
    """value / max(value) across the rows of a small aggregate (bar lengths)."""
    return agg.withColumn(out, round_np(F.col(value) / F.max(value).over(Window.partitionBy()), 4))


def city_rides_ratio(df: DataFrame) -> DataFrame:
    return ratio_to_max(df.groupBy("city").agg(F.count(F.lit(1)).alias("rides")), "rides")
