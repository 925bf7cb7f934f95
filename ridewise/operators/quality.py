"""Validation and data quality.

All metrics of the 21 acceptance checks come from one aggregate pass over
the table plus one grouped count for duplicates; the checks are then laid
out as rows (``inline`` of an array of structs) on the one-row result.
Set equality is decided from counts (values outside the set, members
present), so no value set is ever collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewise import config as C
from ridewise.functions.columns import not_in, round_np
from ridewise.operators.clean import DEDUP_KEYS, RAW_COLUMNS


# B1 -----------------------------------------------------------------------------
def missing_columns(df: DataFrame, required: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Required columns absent from the table's schema (metadata only)."""
    missing = sorted(set(required) - set(df.columns))
    return df.sparkSession.createDataFrame([(m,) for m in missing], "column string")


# B2 -----------------------------------------------------------------------------
def invalid_categories(df: DataFrame, domains: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Distinct values outside the valid set per categorical column (null included)."""
    domains = domains or {"city": C.VALID_CITIES, "vehicle_type": C.VALID_VEHICLE_TYPES,
                          "weather": C.VALID_WEATHER}
    parts = [df.where(not_in(c, vals)).select(F.lit(c).alias("column"), F.col(c).alias("value")).distinct()
             for c, vals in domains.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# B3 / B4 ---------------------------------------------------------------------------
def null_profile(df: DataFrame, only_positive: bool = True) -> DataFrame:
    """Null count and % per column in one pass (columns with nulls only)."""
    n = F.count(F.lit(1))
    wide = df.agg(n.alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = wide.unpivot("_n", df.columns, "column", "null_count")
    out = long.select("column", "null_count",
                      round_np(F.col("null_count") * 100.0 / F.col("_n"), 4).alias("null_pct"))
    return out.where(F.col("null_count") > 0) if only_positive else out


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """dtype, null count, null %, distinct count (nulls excluded) per column."""
    types, cols = dict(df.dtypes), df.columns
    if approx:
        aggs = [F.count(F.lit(1)).alias("_n")]
        for c in cols:
            aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"), F.approx_count_distinct(c).alias(f"{c}__distinct")]
        per = df.agg(*aggs).select("_n", F.inline(F.array(*(F.struct(
            F.lit(i).alias("_c"), F.col(f"`{c}__nulls`").alias("null_count"), F.col(f"`{c}__distinct`").alias("distinct_count"))
            for i, c in enumerate(cols)))))
    else:
        # equal values meet on the map side first, then by (column, value): a column of few
        # values moves few rows, one of many is spread over all tasks; no rows are expanded
        cells = df.select(F.inline(F.array(*(F.struct(F.lit(i).alias("_c"), F.col(f"`{c}`").cast("string").alias("_v")) for i, c in enumerate(cols)))))
        per = cells.groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_k")).groupBy("_c").agg(
            F.sum("_k").alias("_n"), F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_k"))), F.lit(0)).alias("null_count"),
            F.count("_v").alias("distinct_count"))
    names, kinds = (F.array(*map(F.lit, v)) for v in (cols, [types[c] for c in cols]))
    return per.select(F.get(names, F.col("_c")).alias("column"), F.get(kinds, F.col("_c")).alias("dtype"), F.col("null_count").cast("long").alias("null_count"),
                      round_np(F.col("null_count") * 100.0 / F.col("_n"), 4).alias("null_pct"), F.col("distinct_count").cast("long").alias("distinct_count"))


# B5 / B6 / B7 ----------------------------------------------------------------------
def outlier_counts(df: DataFrame) -> DataFrame:
    fare, dist, wait = F.col("fare_inr"), F.col("distance_km"), F.col("wait_time_min")
    return df.agg(
        F.count_if((fare < C.FARE_MIN) | (fare > C.FARE_MAX)).alias("fare_inr"),
        F.count_if((dist < C.DISTANCE_MIN) | (dist > C.DISTANCE_MAX)).alias("distance_km"),
        F.count_if(wait > C.WAIT_MAX).alias("wait_time_min"))


def fare_outlier_expr() -> Column:
    fare = F.col("fare_inr")
    return (fare <= 0) | (fare > C.FARE_MAX)


def fare_outliers(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(fare_outlier_expr()).alias("fare_outliers"))


def duplicate_count_df(df: DataFrame, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """Rows beyond the first per key (nulls compare equal): one grouped count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
              .agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicates")))


# B8 / B9 ---------------------------------------------------------------------------
def _set_mismatch(c: str, valid: Sequence[str]) -> Column:
    """0 when the column's distinct values (null counted) equal ``valid``:
    rows outside the set plus members of the set that never occur."""
    outside = F.count_if(not_in(c, valid))
    absent = sum((~F.coalesce(F.bool_or(F.col(c) == F.lit(v)), F.lit(False))).cast("long") for v in valid)
    return outside + absent


def _subset_mismatch(c: str, valid: Sequence[str]) -> Column:
    """0 when every value (null counted) is in ``valid``: rows outside the set."""
    return F.count_if(not_in(c, valid))


def _yyyymmdd(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("double")


def quality_checks(df: DataFrame, min_rows: int = C.CHECK_MIN_ROWS,
                   first_date: str = C.CHECK_MIN_FIRST_DATE,
                   last_date: str = C.CHECK_MAX_LAST_DATE) -> DataFrame:
    """The 21 acceptance checks as rows (check_id, check_name, observed, status).

    status is PASS when the condition holds, else WARN for warning-only checks
    and FAIL for the rest.
    """
    missing = len(set(RAW_COLUMNS) - set(df.columns))
    h = F.hour("ts")
    m = df.agg(
        F.count(F.lit(1)).alias("n"),
        _set_mismatch("city", C.VALID_CITIES).alias("city_set"),
        _yyyymmdd(F.min(F.to_date("ts"))).alias("min_date"),
        _yyyymmdd(F.max(F.to_date("ts"))).alias("max_date"),
        F.median("wait_time_min").alias("med_wait"),
        F.avg("surge_multiplier").alias("mean_surge"),
        F.median("fare_inr").alias("med_fare"),
        (F.avg(F.col("is_completed").cast("double")) * 100).alias("completion"),
        F.median("driver_rating").alias("med_rating"),
        _set_mismatch("vehicle_type", C.VALID_VEHICLE_TYPES).alias("vehicle_set"),
        _subset_mismatch("weather", C.VALID_WEATHER).alias("weather_subset"),
        (F.avg(F.coalesce((F.col("weather") == "clear"), F.lit(False)).cast("double")) * 100).alias("clear_pct"),
        F.count_if(F.col("wait_time_min").isNull()).alias("null_wait"),
        F.count_if(F.col("driver_rating").isNull()).alias("null_rating"),
        F.count_if(F.col("pickup_zone").isNull()).alias("null_zone"),
        F.count_if(fare_outlier_expr()).alias("fare_outliers"),
        (F.avg(h.isin(C.CHECK_PEAK_HOURS).cast("double")) * 100).alias("peak_pct"),
        F.count_if(F.col("is_festival")).alias("festival_rides"),
        F.count_if(F.col("is_ipl_day")).alias("ipl_rides"),
    ).withColumn("dupes", duplicate_count_df(df).scalar())

    def between(x, lo, hi):
        return (F.col(x) >= lo) & (F.col(x) <= hi)

    d1 = float(first_date.replace("-", ""))
    d2 = float(last_date.replace("-", ""))
    specs = [  # id, name, observed, condition, warn-only
        (1, "all_columns_present", F.lit(float(missing)), F.lit(missing == 0), False),
        (2, "row_count", F.col("n"), F.col("n") >= min_rows, False),
        (3, "city_set", F.col("city_set"), F.col("city_set") == 0, False),
        (4, "first_date", F.col("min_date"), F.col("min_date") <= d1, False),
        (5, "last_date", F.col("max_date"), F.col("max_date") >= d2, False),
        (6, "median_wait", F.col("med_wait"), between("med_wait", 4.0, 12.0), False),
        (7, "mean_surge", F.col("mean_surge"), between("mean_surge", 1.0, 2.0), False),
        (8, "median_fare", F.col("med_fare"), between("med_fare", 80.0, 400.0), False),
        (9, "completion_pct", F.col("completion"), between("completion", 80.0, 97.0), False),
        (10, "median_rating", F.col("med_rating"), between("med_rating", 3.5, 4.8), False),
        (11, "vehicle_set", F.col("vehicle_set"), F.col("vehicle_set") == 0, False),
        (12, "weather_subset", F.col("weather_subset"), F.col("weather_subset") == 0, False),
        (13, "clear_share_pct", F.col("clear_pct"), between("clear_pct", 50.0, 85.0), True),
        (14, "null_wait_present", F.col("null_wait"), F.col("null_wait") > 0, True),
        (15, "null_rating_present", F.col("null_rating"), F.col("null_rating") > 0, True),
        (16, "null_zone_present", F.col("null_zone"), F.col("null_zone") > 0, True),
        (17, "fare_outliers_present", F.col("fare_outliers"), F.col("fare_outliers") > 0, True),
        (18, "duplicates_present", F.col("dupes"), F.col("dupes") > 0, True),
        (19, "peak_share_pct", F.col("peak_pct"), between("peak_pct", 15.0, 70.0), False),
        (20, "festival_rides_present", F.col("festival_rides"), F.col("festival_rides") > 0, True),
        (21, "ipl_rides_present", F.col("ipl_rides"), F.col("ipl_rides") > 0, True),
    ]
    rows = []
    for cid, name, obs, cond, warn in specs:
        status = F.when(F.coalesce(cond, F.lit(False)), "PASS").otherwise("WARN" if warn else "FAIL")
        rows.append(F.struct(F.lit(cid).alias("check_id"), F.lit(name).alias("check_name"),
                             round_np(obs.cast("double"), 4).alias("observed"),
                             F.lit("WARN" if warn else "FAIL").alias("severity"),
                             status.alias("status")))
    return m.select(F.inline(F.array(*rows)))


# B10 --------------------------------------------------------------------------------
def quality_verdict(checks: DataFrame) -> DataFrame:
    """Number of failed checks and the process exit code it maps to."""
    return checks.agg(
        F.count_if(F.col("status") == "FAIL").alias("failures"),
        F.count_if(F.col("status") == "WARN").alias("warnings"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
    ).withColumn("exit_code", F.when(F.col("failures") > 0, 1).otherwise(0))


def validation_issues(df: DataFrame) -> DataFrame:
    """Stage-2 validation of the ETL (B1–B7) as (issue, column, value, count) rows."""
    inv = invalid_categories(df).select(F.lit("invalid_value").alias("issue"), "column",
                                        F.col("value"), F.lit(None).cast("long").alias("count"))
    nulls = null_profile(df).select(F.lit("nulls_before_cleaning").alias("issue"), "column",
                                    F.lit(None).cast("string").alias("value"),
                                    F.col("null_count").alias("count"))
    outs = outlier_counts(df).unpivot([], ["fare_inr", "distance_km", "wait_time_min"], "column", "count") \
        .select(F.lit("outliers_before_cleaning").alias("issue"), "column",
                F.lit(None).cast("string").alias("value"), "count")
    dupes = duplicate_count_df(df).select(F.lit("duplicates_before_cleaning").alias("issue"),
                                          F.lit(None).cast("string").alias("column"),
                                          F.lit(None).cast("string").alias("value"),
                                          F.col("duplicates").alias("count"))
    return inv.unionByName(nulls).unionByName(outs).unionByName(dupes)
