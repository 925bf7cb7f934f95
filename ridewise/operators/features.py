"""Feature engineering (D1–D35) and categorical encoding.

All features are column expressions in one projection, except
``hourly_ride_volume`` (aggregate + broadcast join back) and the label
codes (distinct values → sorted index → broadcast join).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewise import config as C
from ridewise.functions.columns import col_, flag, lookup, round_np, season, surge_band, wait_band
from ridewise.functions.joins import proven_broadcast
from ridewise.functions.lineage import cut_lineage

VOLUME_KEYS = ["city", "date", "hour"]


# -- D1–D6: calendar features -------------------------------------------------

def time_features(ts: str = "ts") -> dict[str, Column]:
    t = F.col(ts)
    return {
        "hour": F.hour(t),
        "day_of_week": F.weekday(t),                      # 0 = Monday
        "day_name": F.date_format(t, "EEEE"),
        "month": F.month(t),
        "month_name": F.date_format(t, "MMMM"),
        "week_of_year": F.weekofyear(t),                  # ISO week
        "quarter": F.quarter(t),
        "date": F.to_date(t),
    }


# -- D7–D11: period, season, weather flags ------------------------------------

def period_flags(hour="hour", dow="day_of_week") -> dict[str, Column]:
    h, d = col_(hour), col_(dow)
    return {
        "is_peak_hour": flag(h.isin(C.PEAK_HOURS)),
        "is_weekend": flag(d >= 5),
        "is_night": flag(h.isin(C.NIGHT_HOURS)),
        "is_late_night": flag(h.isin(C.LATE_NIGHT_HOURS)),
    }


def weather_flags(weather="weather") -> dict[str, Column]:
    w = col_(weather)
    return {
        "is_raining": flag(w.isin("light_rain", "heavy_rain")),
        "is_heavy_rain": flag(w == "heavy_rain"),
        "is_fog": flag(w == "fog"),
    }


# -- D12–D16: ratios, pressure, bands -----------------------------------------

def fare_per_km(fare="fare_inr", dist="distance_km") -> Column:
    return round_np(col_(fare) / F.nullif(col_(dist), F.lit(0.0)), 2)


def demand_pressure(surge="surge_multiplier", peak="is_peak_hour", rain="is_raining",
                    festival="is_festival", ipl="is_ipl_day", digits: int = 3) -> Column:
    raw = (col_(surge)
           + col_(peak).cast("double") * F.lit(C.PRESSURE_PEAK)
           + col_(rain).cast("double") * F.lit(C.PRESSURE_RAIN)
           + col_(festival).cast("int").cast("double") * F.lit(C.PRESSURE_FESTIVAL)
           + col_(ipl).cast("int").cast("double") * F.lit(C.PRESSURE_IPL))
    return round_np(raw, digits)


def is_high_surge(surge="surge_multiplier") -> Column:
    return flag(col_(surge) >= F.lit(C.HIGH_SURGE_THRESHOLD))


def surge_breakdown_leftclosed(df: DataFrame, surge: str = "surge_multiplier") -> DataFrame:
    """Share (%) of rides in the raw-notebook left-closed surge bins."""
    s = F.col(surge)
    aggs = []
    for i, (lo, hi) in enumerate(zip(C.RAW_SURGE_EDGES, C.RAW_SURGE_EDGES[1:])):
        aggs.append(F.avg(((s >= lo) & (s < hi)).cast("double")).alias(f"b{i}"))
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(i).alias("band_order"), F.lit(lab).alias("band"),
                     round_np(F.col(f"b{i}") * 100, 1).alias("pct"))
            for i, lab in enumerate(C.RAW_SURGE_LABELS)]
    return wide.select(F.inline(F.array(*rows)))


# -- D18–D20: volume and high-demand flag ------------------------------------

def hourly_volume_table(df: DataFrame) -> DataFrame:
    """Rides per (city, date, hour) — partial aggregation, tiny output."""
    return df.groupBy(*VOLUME_KEYS).agg(F.count(F.lit(1)).alias("hourly_ride_volume"))


def city_volume_p75(volume: DataFrame, q: float = 0.75) -> DataFrame:
    """Ride-weighted quantile of the hourly volume per city.

    Taken over the hourly table with each volume weighted by itself
    (``percentile(v, q, frequency=v)``), which equals the quantile over ride
    rows without going back to the ride level.
    """
    v = F.col("hourly_ride_volume")
    return volume.groupBy("city").agg(F.percentile(v, q, v).alias("city_volume_p75"))


def add_volume_features(df: DataFrame) -> DataFrame:
    """D18 + D20: hourly_ride_volume and is_high_demand joined back per ride.

    The (city, date, hour) table grows with the time span, not with the ride
    count. It is stored first, so the planner knows its bytes and broadcasts it
    only under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    vol = cut_lineage(hourly_volume_table(df), "hourly-volume")
    vol = vol.join(proven_broadcast(city_volume_p75(vol)), "city").withColumn(
        "is_high_demand", flag(F.col("hourly_ride_volume") >= F.col("city_volume_p75"))
    ).drop("city_volume_p75")
    return df.join(vol, VOLUME_KEYS, "left")


# -- D21–D22, D33–D35 ---------------------------------------------------------

def is_event_day(festival="is_festival", ipl="is_ipl_day") -> Column:
    return F.greatest(col_(festival).cast("int"), col_(ipl).cast("int"))


def minutes_since_midnight(ts="ts") -> Column:
    return F.hour(col_(ts)) * 60 + F.minute(col_(ts))


def event_type(festival="is_festival", ipl="is_ipl_day") -> Column:
    return (F.when(col_(festival), F.lit("Festival day"))
             .when(col_(ipl), F.lit("IPL match day"))
             .otherwise(F.lit("Normal day")))


def is_cancelled(completed="is_completed") -> Column:
    return (~col_(completed)).cast("int")


def year_month(ts="ts") -> Column:
    return F.date_format(col_(ts), "yyyy-MM")


# -- D24: cyclical encoding ----------------------------------------------------

def cyclical(hour="hour", dow="day_of_week") -> dict[str, Column]:
    two_pi = 2 * math.pi
    h, d = col_(hour).cast("double"), col_(dow).cast("double")
    return {
        "hour_sin": F.sin(F.lit(two_pi) * h / F.lit(24.0)),
        "hour_cos": F.cos(F.lit(two_pi) * h / F.lit(24.0)),
        "dow_sin": F.sin(F.lit(two_pi) * d / F.lit(7.0)),
        "dow_cos": F.cos(F.lit(two_pi) * d / F.lit(7.0)),
    }


def cyclical_encode(df: DataFrame) -> DataFrame:
    return df.withColumns(cyclical())


# -- D25–D27: encodings --------------------------------------------------------

LABEL_COLUMNS = {"city": "city_code", "vehicle_type": "vehicle_code", "weather": "weather_code"}


def code_table(df: DataFrame, column: str, code_name: str) -> DataFrame:
    """value → index among the sorted distinct values (tiny: one row per value)."""
    return (df.select(column).where(F.col(column).isNotNull()).distinct()
              .withColumn(code_name, (F.row_number().over(Window.orderBy(column)) - 1).cast("int")))


def label_encode(df: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Alphabetical label codes. Runs on validated columns, whose
    combinations (at most 100 for the three of the ride table) are found in
    one scan and stored; each code table comes from those."""
    columns = columns or LABEL_COLUMNS
    values = cut_lineage(df.select(*columns).distinct(), "codes")
    out = df
    for column, code in columns.items():
        out = out.join(code_table(values, column, code), column, "left")
    return out


def season_code(season_col="season") -> Column:
    return lookup(season_col, C.SEASON_CODES).cast("int")


def encoding_maps(df: DataFrame) -> DataFrame:
    """One row per encoded column with its value → code map."""
    parts = []
    for column, code in LABEL_COLUMNS.items():
        t = code_table(df, column, code)
        parts.append(t.agg(F.map_from_entries(F.sort_array(F.collect_list(
            F.struct(F.col(column).alias("k"), F.col(code).alias("v"))))).alias("codes"))
            .select(F.lit(column).alias("column"), "codes"))
    season_map = F.create_map(*[x for k, v in C.SEASON_CODES.items() for x in (F.lit(k), F.lit(v))])
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    fixed = df.sparkSession.range(1).select(F.lit("season").alias("column"),
                                            season_map.alias("codes"))
    return out.unionByName(fixed)


# -- D28–D32: calendar and tariff lookups ---------------------------------------

def festival_calendar(spark, dates: Sequence[str] | None = None) -> DataFrame:
    rows = [(d,) for d in (dates or C.FESTIVAL_DATES)]
    return spark.createDataFrame(rows, "d string").select(F.to_date("d").alias("date"))


def ipl_calendar(spark, matches: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    rows = [(c, d) for c, ds in (matches or C.IPL_MATCHES).items() for d in ds]
    return spark.createDataFrame(rows, "city string, d string").select(
        "city", F.to_date("d").alias("date"))


def calendar_enrich(df: DataFrame, ts: str = "ts") -> DataFrame:
    """is_festival / is_ipl_day from the calendars (two broadcast joins)."""
    spark = df.sparkSession
    fest = festival_calendar(spark).withColumn("_fest", F.lit(True))
    ipl = ipl_calendar(spark).withColumn("_ipl", F.lit(True))
    d = df.withColumn("_d", F.to_date(ts))
    return (d.join(F.broadcast(fest.withColumnRenamed("date", "_d")), "_d", "left")
             .join(F.broadcast(ipl.withColumnRenamed("date", "_d")), ["city", "_d"], "left")
             .withColumns({"is_festival": F.coalesce("_fest", F.lit(False)),
                           "is_ipl_day": F.coalesce("_ipl", F.lit(False))})
             .drop("_d", "_fest", "_ipl"))


def demand_multiplier(hour="hour", dow="day_of_week", weather="weather") -> Column:
    """Hour factor × weekend factors × weather factor (random event factors left out)."""
    h = col_(hour)
    weekend = col_(dow) >= 5
    wk = F.when(weekend & h.between(18, 23), F.lit(C.WEEKEND_DEMAND * C.WEEKEND_EVENING_DEMAND)) \
          .when(weekend, F.lit(C.WEEKEND_DEMAND)).otherwise(F.lit(1.0))
    return lookup(h, C.HOUR_DEMAND) * wk * lookup(weather, C.WEATHER_DEMAND)


def expected_fare(vehicle="vehicle_type", dist="distance_km", surge="surge_multiplier") -> Column:
    """(base_fare + per_km · distance) · surge from the tariff table."""
    base = lookup(vehicle, {k: v[1] for k, v in C.VEHICLE_TARIFFS.items()})
    per_km = lookup(vehicle, {k: v[2] for k, v in C.VEHICLE_TARIFFS.items()})
    return (base + per_km * col_(dist)) * col_(surge)


def snap_to_step(c, step: float) -> Column:
    """Quantise to a step (0.25 for surge, 0.5 for rating), half to even."""
    return F.rint(col_(c) / F.lit(step)) * F.lit(step)


# -- D23: composition ----------------------------------------------------------

def engineer_features(df: DataFrame) -> DataFrame:
    """The 25 derived columns of the feature stage (no encoding)."""
    base = df.withColumns(time_features())
    base = base.withColumns({**period_flags(), "season": season("month"), **weather_flags()})
    base = base.withColumns({
        "fare_per_km": fare_per_km(),
        "demand_pressure": demand_pressure(),
        "is_high_surge": is_high_surge(),
        "surge_band": surge_band(),
        "wait_band": wait_band(),
    })
    base = add_volume_features(base)
    return base.withColumns({
        "is_event_day": is_event_day(),
        "minutes_since_midnight": minutes_since_midnight(),
    })


FEATURE_ORDER = [
    "hour", "day_of_week", "day_name", "month", "month_name", "week_of_year", "quarter", "date",
    "is_peak_hour", "is_weekend", "is_night", "is_late_night", "season",
    "is_raining", "is_heavy_rain", "is_fog", "fare_per_km", "demand_pressure",
    "is_high_surge", "surge_band", "wait_band", "hourly_ride_volume", "is_high_demand",
    "is_event_day", "minutes_since_midnight", "city_code", "vehicle_code", "weather_code",
    "season_code",
]


def encode(df: DataFrame) -> DataFrame:
    """Stage 5: label codes for city / vehicle / weather, fixed season codes."""
    return label_encode(df).withColumn("season_code", season_code())


def enrich(clean: DataFrame) -> DataFrame:
    """Clean rides → 43-column enriched table (feature stage + encode stage)."""
    from ridewise.operators.clean import RAW_COLUMNS
    out = encode(engineer_features(clean))
    return out.select(*RAW_COLUMNS, *FEATURE_ORDER)
