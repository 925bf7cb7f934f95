"""Cleaning stage (C1–C13): dedup, domain filter, imputation, winsorising.

Order follows the reference's clean(): dedup → filter → impute wait
(group, then global) → impute rating → impute zone → clip fare, distance,
wait, surge, rating.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ridewise import config as C
from ridewise.functions.columns import clip, portable_hash
from ridewise.functions.joins import proven_broadcast
from ridewise.functions.lineage import bounded_tasks, cut_lineage
from ridewise.functions.quantiles import exact_quantiles

DEDUP_KEYS = ["city", "ts", "vehicle_type", "distance_km"]
RAW_COLUMNS = ["ride_id", "ts", "city", "pickup_zone", "vehicle_type", "wait_time_min",
               "surge_multiplier", "distance_km", "fare_inr", "driver_rating", "is_completed",
               "weather", "is_festival", "is_ipl_day"]


def dedup_rides(df: DataFrame, keys: Sequence[str] = DEDUP_KEYS,
                tie_break: str = "ride_id") -> DataFrame:
    """Keep one row per key — the one with the smallest ``tie_break``.

    Expressed as an aggregate (min of a struct led by the tie-break) rather
    than a row_number window: partial aggregation collapses copies of a hot
    key on the map side, so a key holding a third of all rows never lands in
    one task. Null keys group together, as in pandas.
    """
    cols = df.columns
    rest = [c for c in cols if c not in keys and c != tie_break]
    # numbers and times first: the sort below compares them by a prefix, texts of a small domain one by one
    by = sorted(keys, key=lambda c: df.schema[c].dataType.typeName() == "string")
    return (df.groupBy(*by)
              .agg(F.min(F.struct(tie_break, *rest)).alias("_keep"))
              .select(*keys, "_keep.*")
              .select(*cols))


def filter_valid_categories(df: DataFrame, cities=None, vehicles=None, weather=None) -> DataFrame:
    """Keep rows whose city, vehicle type and weather are in the valid sets (nulls out)."""
    return df.filter(F.col("city").isin(list(cities or C.VALID_CITIES))
                     & F.col("vehicle_type").isin(list(vehicles or C.VALID_VEHICLE_TYPES))
                     & F.col("weather").isin(list(weather or C.VALID_WEATHER)))


def clean_medians(df: DataFrame, keys: Sequence[str] = ("city", "vehicle_type")) -> DataFrame:
    """Exact medians that imputation needs: (kind, key, median), one run for all.

    kind 'wait' has the (city, vehicle_type) groups, kind 'rating' the cities;
    domains are validated before (at most 30 rows). Runs jobs.
    """
    rows = df.select(F.inline(F.array(
        F.struct(F.lit("wait").alias("kind"), group_key(*keys).alias("key"), F.col("wait_time_min").cast("double").alias("v")),
        F.struct(F.lit("rating").alias("kind"), group_key("city").alias("key"), F.col("driver_rating").cast("double").alias("v")))))
    return exact_quantiles(rows, ["kind", "key"], [0.5]).select("kind", "key", F.col("quantile").alias("median"))


def group_key(*columns: str):
    """Columns of validated domains (or null) as one text."""
    return F.concat_ws("|", *(F.coalesce(F.col(c), F.lit("")) for c in columns))


def _joined_median(df: DataFrame, medians: DataFrame, kind: str, column: str, keys: Sequence[str]) -> DataFrame:
    med = medians.where(F.col("kind") == kind).select(F.col("key").alias("_key"), F.col("median").alias("_median"))
    return (df.join(proven_broadcast(med), group_key(*keys) == F.col("_key"), "left")
              .withColumn(column, F.coalesce(column, "_median")).select(*df.columns))


def impute_wait_group_median(df: DataFrame, keys=("city", "vehicle_type"), medians: DataFrame | None = None) -> DataFrame:
    """Null wait → exact median of its (city, vehicle_type) group.

    The median table has one row per group of a validated domain (≤ 25 rows),
    so it is broadcast back; the fact table is never shuffled for this.
    """
    return _joined_median(df, clean_medians(df, keys) if medians is None else medians, "wait", "wait_time_min", list(keys))


def impute_wait_global_median(df: DataFrame, empty: DataFrame | None = None) -> DataFrame:
    """C4: remaining null wait → exact median of the (already group-filled) column.

    Where a first look finds no null, nothing is computed; ``empty``, if given,
    is the part of ``df`` that is looked at (the rows that had no wait before).
    """
    if not (df if empty is None else empty).where("wait_time_min is null").limit(1).count():
        return df
    q = exact_quantiles(df.select(F.lit(0).alias("all"), F.col("wait_time_min").alias("v")), ["all"], [0.5])
    return df.withColumn("wait_time_min", F.coalesce(F.col("wait_time_min"), q.agg(F.max("quantile")).scalar()))


def impute_rating_city_median(df: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """Null rating → exact city median; a city without any rating stays null."""
    return _joined_median(df, clean_medians(df) if medians is None else medians, "rating", "driver_rating", ["city"])


def zone_map_column(zones: Mapping[str, Sequence[str]]):
    pairs = []
    for city, zs in zones.items():
        pairs += [F.lit(city), F.array(*[F.lit(z) for z in zs])]
    return F.create_map(*pairs)


def impute_zone(df: DataFrame, zones: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Null zone → a zone of the ride's city; unknown city → 'Unknown'.

    The pick is deterministic (md5 of ride_id modulo the list length) instead
    of a seeded random draw, so re-running a task gives the same answer.
    """
    zones = zones or C.CITY_ZONES
    arr = F.try_element_at(zone_map_column(zones), F.col("city"))
    pick = F.element_at(arr, (F.pmod(portable_hash("ride_id"), F.size(arr)) + 1).cast("int"))
    filled = F.when(arr.isNull(), F.lit(C.UNKNOWN_ZONE)).otherwise(pick)
    return df.withColumn("pickup_zone", F.coalesce(F.col("pickup_zone"), filled))


def clip_fare(df: DataFrame, lo=C.FARE_MIN, hi=C.FARE_MAX) -> DataFrame:
    """Winsorise fare to [10, 5000]."""
    return df.withColumn("fare_inr", clip("fare_inr", lo, hi))


def clip_distance(df: DataFrame, lo=C.DISTANCE_MIN, hi=C.DISTANCE_MAX) -> DataFrame:
    """Clip distance to [0.5, 80]."""
    return df.withColumn("distance_km", clip("distance_km", lo, hi))


def clip_wait(df: DataFrame, lo=C.WAIT_MIN, hi=C.WAIT_MAX) -> DataFrame:
    """Clip wait to [0.5, 120]."""
    return df.withColumn("wait_time_min", clip("wait_time_min", lo, hi))


def clip_surge_rating(df: DataFrame) -> DataFrame:
    """Surge to [1, 4], rating to [1, 5]."""
    return df.withColumns({
        "surge_multiplier": clip("surge_multiplier", C.SURGE_MIN, C.SURGE_MAX),
        "driver_rating": clip("driver_rating", C.RATING_MIN, C.RATING_MAX),
    })


def _impute(df: DataFrame, zones) -> DataFrame:
    medians = clean_medians(df)
    # the scan finds these few rows by a pushed filter; behind the join it could not
    empty = impute_wait_group_median(df.where("wait_time_min is null"), medians=medians)
    return (df.transform(impute_wait_group_median, medians=medians)
              .transform(impute_wait_global_median, empty)
              .transform(impute_rating_city_median, medians)
              .transform(impute_zone, zones))


def _clip_all(df: DataFrame) -> DataFrame:
    return (df.transform(clip_fare).transform(clip_distance)
              .transform(clip_wait).transform(clip_surge_rating))


def deduped_valid(df: DataFrame, cities=None, vehicles=None, weather=None,
                  materialise: bool = True) -> DataFrame:
    """C1 + C2, written once (the one fact-table shuffle of the stage).

    The imputation medians, the global median and the final projection all
    read this table; materialising it keeps them from repeating the dedup
    shuffle (each consumer prunes a different column set, so Spark could not
    reuse the exchange).
    """
    v = filter_valid_categories(dedup_rides(df), cities, vehicles, weather)
    return cut_lineage(v, "dedup_valid") if materialise else v


def clean_from_deduped(deduped: DataFrame, zones: Mapping[str, Sequence[str]] | None = None,
                       cities=None, vehicles=None, weather=None, observation: Observation | None = None) -> DataFrame:
    """C2–C10 over an already deduplicated (and stored) table.

    ``observation`` counts what imputation and clipping change while the result
    is written, so the report (C12) needs no pass of its own.
    """
    valid = filter_valid_categories(deduped, cities, vehicles, weather)
    if observation is None:
        return valid.transform(_impute, zones).transform(_clip_all)
    marked = valid.withColumns({f"_{c}": F.col(c).isNull() for c in IMPUTED})
    imputed = marked.transform(_impute, zones)
    fare, dist, wait = F.col("fare_inr"), F.col("distance_km"), F.col("wait_time_min")
    counted = imputed.observe(
        observation, F.count(F.lit(1)).alias("rows_after"),
        *(F.count_if(f"_{c}").alias(n) for c, n in IMPUTED.items()),
        F.count_if((fare < C.FARE_MIN) | (fare > C.FARE_MAX)).alias("fare_outliers_capped"),
        F.count_if((dist < C.DISTANCE_MIN) | (dist > C.DISTANCE_MAX)).alias("distance_outliers_capped"),
        F.count_if(wait > C.WAIT_MAX).alias("wait_outliers_capped"),
        # clipping keeps nulls, so those of the result are counted here too
        F.coalesce(F.sum(null_cells(imputed, RAW_COLUMNS)), F.lit(0)).cast("long").alias("remaining_nulls"))
    return counted.drop(*(f"_{c}" for c in IMPUTED)).transform(_clip_all)


#: Columns with imputed values and the report's names for their counts.
IMPUTED = {"wait_time_min": "wait_time_imputed", "driver_rating": "driver_rating_imputed", "pickup_zone": "pickup_zone_imputed"}
REPORT_COLUMNS = ["rows_before", "duplicates_removed", "invalid_categoricals_removed", *IMPUTED.values(), "fare_outliers_capped",
                  "distance_outliers_capped", "wait_outliers_capped", "remaining_nulls", "rows_after", "rows_removed"]


def clean_rides(df: DataFrame, zones: Mapping[str, Sequence[str]] | None = None,
                cities=None, vehicles=None, weather=None, materialise: bool = True) -> DataFrame:
    """Dedup + domain filter (materialised), then imputation and clipping."""
    return (deduped_valid(df, cities, vehicles, weather, materialise)
              .transform(_impute, zones)
              .transform(_clip_all))


def null_cells(df: DataFrame, columns: Sequence[str] | None = None):
    """Expression: total number of null cells across ``columns`` of a row."""
    cols = list(columns or df.columns)
    return sum(F.col(c).isNull().cast("long") for c in cols)


def remaining_nulls(df: DataFrame) -> DataFrame:
    """C11: total null cells (one row)."""
    return df.agg(F.sum(null_cells(df)).cast("long").alias("remaining_nulls"))


def cleaning_report(raw: DataFrame, deduped: DataFrame, observed: dict[str, int]) -> DataFrame:
    """The cleaning counters as one row.

    ``observed`` is what ``clean_from_deduped``'s observation counted while the
    cleaned table was written; the row counts before and after dedup are counts
    of stored tables (Parquet footers answer them).
    """
    rows_before, rows_dedup = (t.agg(F.count(F.lit(1))).scalar() for t in (raw, deduped))
    seen = {c: F.lit(observed[c]).cast("long") for c in observed}
    counters = {"rows_before": rows_before, "duplicates_removed": rows_before - rows_dedup,
                "invalid_categoricals_removed": rows_dedup - seen["rows_after"], "rows_removed": rows_before - seen["rows_after"]}
    return raw.sparkSession.range(1).select(*((counters | seen)[c].alias(c) for c in REPORT_COLUMNS))


def clean_with_report(raw: DataFrame, zones: Mapping[str, Sequence[str]] | None = None):
    """C13 and C12 sharing one materialised dedup and one imputation, whose counters are observed as it is written."""
    seen = Observation()
    with bounded_tasks(raw.sparkSession):
        deduped = cut_lineage(dedup_rides(raw), "dedup")
    clean = cut_lineage(clean_from_deduped(deduped, zones, observation=seen), "clean")
    return clean, cleaning_report(raw, deduped, seen.get)
