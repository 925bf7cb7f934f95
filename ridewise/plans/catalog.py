"""Registered queries: name → (Spark job over the driver tables, DuckDB oracle).

Each Spark job reads the given tables (through the shared stages) and returns
a lazy DataFrame; the oracle text recomputes the same result independently in
DuckDB from the same parquet tables. Columns carry the same names on both
sides; doubles are rounded half-to-even on both sides.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewise import config as C
from ridewise.functions.lineage import bounded_tasks, cut_lineage
from ridewise.operators import clean as CL
from ridewise.operators import eda as E
from ridewise.operators import features as D
from ridewise.plans import stages as S
from ridewise.plans.oracle_text import on_clean, on_feat, on_raw

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


def _feat(spark, sf):
    return S.enriched(spark, sf)


# ---------------------------------------------------------------------------
# C: cleaning
# ---------------------------------------------------------------------------

@register("clean_rides", on_clean("select * from clean"))
def q_clean_rides(spark, sf):
    return S.clean(spark, sf)


@register("dedup_rides", on_raw("""
select * exclude (o_rn) from (
  select *, row_number() over (partition by city, ts, vehicle_type, distance_km order by ride_id) as o_rn
  from rides) where o_rn = 1"""))
def q_dedup(spark, sf):
    return S.deduped(spark, sf)


# ---------------------------------------------------------------------------
# D: features
# ---------------------------------------------------------------------------

@register("engineer_features", on_feat("select * from feat"))
def q_features(spark, sf):
    return _feat(spark, sf)


# ---------------------------------------------------------------------------
# F: EDA
# ---------------------------------------------------------------------------

@register("city_stats", on_feat("""
select city, count(*) as rides,
       round_even(quantile_cont(wait_time_min, 0.5), 2) as median_wait,
       round_even(quantile_cont(fare_inr, 0.5), 2) as median_fare,
       round_even(avg(surge_multiplier), 2) as mean_surge,
       round_even(round_even(avg(cast(is_completed as double)), 2) * 100, 1) as completion_rate
from feat group by city"""))
def q_city_stats(spark, sf):
    return E.city_stats(_feat(spark, sf))


@register("hourly_demand", on_feat("""
select hour, count(*) as rides, cast(hour in (7,8,9,17,18,19,20) as integer) as is_peak
from feat group by hour"""))
def q_hourly_demand(spark, sf):
    return E.hourly_demand(_feat(spark, sf))


@register("hourly_by_city", on_feat("""
select hour, city, count(*) as rides from feat
where city in ('Delhi NCR','Mumbai','Bengaluru','Chennai','Hyderabad') group by hour, city"""))
def q_hourly_by_city(spark, sf):
    return E.hourly_by_city(_feat(spark, sf))


@register("peak_dead_share", on_feat("""
select round_even(count(*) filter (where hour in (7,8,9,17,18,19,20)) * 100.0 / count(*), 4) as peak_pct,
       round_even(count(*) filter (where hour in (1,2,3,4)) * 100.0 / count(*), 4) as dead_pct,
       count(*) filter (where hour = 18) as rides_at_18
from feat"""))
def q_peak_dead(spark, sf):
    return E.peak_dead_share(_feat(spark, sf))


@register("busiest_hour", on_feat("""
select hour as busiest_hour, rides,
       (select max(n) from (select count(*) as n from feat group by hour, city)) as max_city_hour_rides
from (select hour, count(*) as rides from feat group by hour)
order by rides desc, hour limit 1"""))
def q_busiest_hour(spark, sf):
    return E.busiest_hour(_feat(spark, sf))


@register("city_metric_median_wait", on_feat("""
select city, round_even(quantile_cont(wait_time_min, 0.5), 4) as value from feat group by city"""))
def q_city_metric_wait(spark, sf):
    return E.city_metric(_feat(spark, sf), "wait_time_min", "median")


@register("city_metric_completion", on_feat("""
select city, round_even(avg(cast(is_completed as double)), 4) as value from feat group by city"""))
def q_city_metric_completion(spark, sf):
    return E.city_metric(_feat(spark, sf), "is_completed", "mean")


@register("city_metric_median_fare", on_feat("""
select city, round_even(quantile_cont(fare_inr, 0.5), 4) as value from feat group by city"""))
def q_city_metric_fare(spark, sf):
    return E.city_metric(_feat(spark, sf), "fare_inr", "median")


@register("city_metric_mean_surge", on_feat("""
select city, round_even(avg(surge_multiplier), 4) as value from feat group by city"""))
def q_city_metric_surge(spark, sf):
    return E.city_metric(_feat(spark, sf), "surge_multiplier", "mean")


@register("city_share", on_feat("""
select city, count(*) as rides, round_even(count(*) * 100.0 / sum(count(*)) over (), 2) as share_pct
from feat group by city"""))
def q_city_share(spark, sf):
    return E.city_share(_feat(spark, sf))


@register("weather_stats", on_feat("""
select weather, count(*) as rides,
       round_even(quantile_cont(wait_time_min, 0.5), 2) as median_wait,
       round_even(avg(surge_multiplier), 2) as mean_surge,
       round_even((1 - avg(cast(is_completed as double))) * 100, 1) as cancel_rate
from feat group by weather"""))
def q_weather_stats(spark, sf):
    return E.weather_stats(_feat(spark, sf))


@register("weather_metric_cancel", on_feat("""
select weather, round_even((1 - avg(cast(is_completed as double))) * 100, 4) as value,
       cast(case weather when 'clear' then 0 when 'fog' then 1 when 'light_rain' then 2
            when 'heavy_rain' then 3 else 4 end as integer) as weather_order
from feat group by weather"""))
def q_weather_metric(spark, sf):
    return E.weather_metric(_feat(spark, sf), "is_completed", "missing_pct")


_WEATHER_ORDER_SQL = """cast(case weather when 'clear' then 0 when 'fog' then 1 when 'light_rain' then 2
            when 'heavy_rain' then 3 else 4 end as integer) as weather_order"""


@register("weather_metric_median_wait", on_feat(f"""
select weather, round_even(quantile_cont(wait_time_min, 0.5), 4) as value, {_WEATHER_ORDER_SQL} from feat group by weather"""))
def q_weather_metric_wait(spark, sf):
    return E.weather_metric(_feat(spark, sf), "wait_time_min", "median")


@register("weather_metric_mean_surge", on_feat(f"""
select weather, round_even(avg(surge_multiplier), 4) as value, {_WEATHER_ORDER_SQL} from feat group by weather"""))
def q_weather_metric_surge(spark, sf):
    return E.weather_metric(_feat(spark, sf), "surge_multiplier", "mean")


_WEATHER_LONG = """
o_wl as (
  select weather, round_even(quantile_cont(wait_time_min, 0.5), 4) as median_wait,
         round_even(avg(surge_multiplier), 4) as mean_surge,
         round_even((1 - avg(cast(is_completed as double))) * 100, 4) as cancel_rate
  from feat group by weather),
o_wlong as (
  select weather, 'median_wait' as metric, median_wait as value from o_wl
  union all select weather, 'mean_surge', mean_surge from o_wl
  union all select weather, 'cancel_rate', cancel_rate from o_wl)"""


@register("weather_lift", on_feat("""
select metric, base_value, other_value,
       round_even(other_value / nullif(base_value, 0) * 100 - 100, 2) as lift_pct
from (select metric, max(case when weather = 'clear' then value end) as base_value,
             max(case when weather = 'heavy_rain' then value end) as other_value
      from o_wlong group by metric)""", _WEATHER_LONG))
def q_weather_lift(spark, sf):
    return E.weather_lift(_feat(spark, sf))


@register("weather_wait_sorted", on_raw("""
select weather, quantile_cont(wait_time_min, 0.5) as median_wait
from rides where weather is not null group by weather"""))
def q_weather_wait_sorted(spark, sf):
    return E.weather_wait_sorted(S.raw(spark, sf))


@register("monthly_trend", on_feat("""
select strftime(ts, '%Y-%m') as year_month, count(*) as rides,
       round_even(avg(surge_multiplier), 4) as mean_surge, round_even(avg(wait_time_min), 4) as mean_wait
from feat group by 1"""))
def q_monthly_trend(spark, sf):
    return E.monthly_trend(_feat(spark, sf))


@register("season_stats", on_feat("""
select season, count(*) as rides, round_even(avg(surge_multiplier), 3) as mean_surge,
       round_even(avg(wait_time_min), 3) as mean_wait,
       round_even(round_even(avg(cast(is_raining as double)), 3) * 100, 1) as rain_pct
from feat group by season"""))
def q_season_stats(spark, sf):
    return E.season_stats(_feat(spark, sf))


@register("festival_effect", on_raw("""
select is_festival, round_even(avg(wait_time_min), 2) as avg_wait, round_even(avg(surge_multiplier), 2) as avg_surge,
       round_even(avg(fare_inr), 2) as avg_fare, count(ride_id) as ride_count,
       case when is_festival then 'Festival day' else 'Normal day' end as day_type
from rides group by is_festival"""))
def q_festival_effect(spark, sf):
    return E.festival_effect(S.raw(spark, sf))


_EVENT = ("case when is_festival then 'Festival day' when is_ipl_day then 'IPL match day' "
          "else 'Normal day' end")


def _event_sql(metric):
    return on_feat(f"""
select event_type, round_even(avg({metric}), 4) as mean_value,
       cast(case event_type when 'Normal day' then 0 when 'IPL match day' then 1
            when 'Festival day' then 2 else 3 end as integer) as event_order
from (select {_EVENT} as event_type, {metric} from feat) group by event_type""")


@register("event_impact", _event_sql("wait_time_min"))
def q_event_impact(spark, sf):
    return E.event_impact(_feat(spark, sf))


@register("event_impact_surge", _event_sql("surge_multiplier"))
def q_event_impact_surge(spark, sf):
    return E.event_impact(_feat(spark, sf), "surge_multiplier")


@register("event_impact_fare", _event_sql("fare_inr"))
def q_event_impact_fare(spark, sf):
    return E.event_impact(_feat(spark, sf), "fare_inr")


@register("event_lift", on_feat(f"""
select metric, round_even(n, 4) as normal_value, round_even(f, 4) as festival_value,
       round_even((f / nullif(n, 0) - 1) * 100, 2) as lift_pct
from (
  select 'wait_time_min' as metric, avg(wait_time_min) filter (where et = 'Normal day') as n,
         avg(wait_time_min) filter (where et = 'Festival day') as f from (select *, {_EVENT} as et from feat)
  union all
  select 'surge_multiplier', avg(surge_multiplier) filter (where et = 'Normal day'),
         avg(surge_multiplier) filter (where et = 'Festival day') from (select *, {_EVENT} as et from feat)
  union all
  select 'fare_inr', avg(fare_inr) filter (where et = 'Normal day'),
         avg(fare_inr) filter (where et = 'Festival day') from (select *, {_EVENT} as et from feat))"""))
def q_event_lift(spark, sf):
    return E.event_lift(_feat(spark, sf))


@register("vehicle_metric", on_feat("""
select vehicle_type, round_even(quantile_cont(fare_per_km, 0.5), 4) as median_fare_per_km,
       round_even(quantile_cont(wait_time_min, 0.5), 4) as median_wait,
       round_even(quantile_cont(fare_inr, 0.5), 4) as median_fare,
       round_even(quantile_cont(distance_km, 0.5), 4) as median_distance
from feat group by vehicle_type"""))
def q_vehicle_metric(spark, sf):
    return E.vehicle_metric(_feat(spark, sf))


_BAND_ORDER = ("cast(case surge_band when 'no_surge' then 0 when 'low' then 1 when 'medium' then 2 "
               "when 'high' then 3 when 'extreme' then 4 else 5 end as integer)")


@register("surge_band_by_city", on_feat(f"""
select city, surge_band, count(*) as rides, {_BAND_ORDER} as band_order
from feat group by city, surge_band"""))
def q_surge_band_by_city(spark, sf):
    return E.surge_band_by_city(_feat(spark, sf))


@register("surge_band_pct", on_feat("""
select city, surge_band, count(*) as rides,
       round_even(count(*) * 100.0 / sum(count(*)) over (partition by city), 2) as pct
from feat group by city, surge_band"""))
def q_surge_band_pct(spark, sf):
    return E.surge_band_pct(_feat(spark, sf))


_HCOLS = ", ".join(f"count(*) filter (where hour = {h}) as h{h:02d}" for h in range(24))
_HLIST = ", ".join(f"h{h:02d}" for h in range(24))


@register("city_hour_heatmap", on_feat(f"""
select *, min(least({_HLIST})) over () as cell_min, max(greatest({_HLIST})) over () as cell_max
from (select city, {_HCOLS} from feat group by city)"""))
def q_city_hour_heatmap(spark, sf):
    return E.city_hour_heatmap(_feat(spark, sf))


@register("hour_dow_heatmap", on_feat(f"""
select day_of_week, {_HCOLS} from feat group by day_of_week"""))
def q_hour_dow_heatmap(spark, sf):
    return E.hour_dow_heatmap(_feat(spark, sf))


def _corr_sql(cols, digits, keep=None):
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    sel = ", ".join(f"corr(cast({a} as double), cast({b} as double)) as \"{a}|{b}\"" for a, b in pairs)
    unions = []
    for a, b in pairs:
        for x, y in ((a, b), (b, a)):
            if keep is None or x in keep:
                unions.append(f"select '{x}' as col_a, '{y}' as col_b, round_even(\"{a}|{b}\", {digits}) as r from o_c")
    return sel, " union all ".join(unions)


_C12_SEL, _C12_UNION = _corr_sql(E.CORR_12, 2)
_C12_DIAG = " union all ".join(f"select '{c}', '{c}', 1.0::double" for c in E.CORR_12)


@register("corr_matrix_12", on_feat(f"""
{_C12_UNION} union all {_C12_DIAG}""", f"o_c as (select {_C12_SEL} from feat)"))
def q_corr_matrix(spark, sf):
    return E.corr_matrix_12(_feat(spark, sf))


_C9_SEL, _C9_UNION = _corr_sql(E.CORR_TARGET_9, 3, keep=("fare_inr", "wait_time_min"))


_RAW_CORR = ["wait_time_min", "surge_multiplier", "fare_inr", "distance_km", "driver_rating"]


@register("corr_raw_pairs", on_raw(" union all ".join(
    f"select '{a}' as col_a, '{b}' as col_b, round_even(corr(cast({a} as double), cast({b} as double)), 4) as r from rides"
    for a in _RAW_CORR for b in _RAW_CORR if a != b)))
def q_corr_raw(spark, sf):
    """F22 on the raw columns, which hold nulls: each pair over its own complete rows."""
    return E.corr_raw(S.raw(spark, sf), _RAW_CORR)


@register("corr_with_target", on_feat(f"""
select col_a as target, col_b as feature, r from ({_C9_UNION})""", f"o_c as (select {_C9_SEL} from feat)"))
def q_corr_with_target(spark, sf):
    return E.corr_with_target(_feat(spark, sf))


@register("zone_hotspots", on_feat("""
select *, case when mean_surge >= 1.6 then 'red' when mean_surge >= 1.55 then 'amber' else 'green' end as badge
from (select pickup_zone, city, round_even(avg(wait_time_min), 4) as avg_wait,
             round_even(avg(surge_multiplier), 4) as mean_surge, count(*) as rides
      from feat group by pickup_zone, city)
order by avg_wait desc, pickup_zone, city limit 10"""))
def q_zone_hotspots(spark, sf):
    return E.zone_hotspots(_feat(spark, sf))


@register("kpi_cards", on_feat("""
select city, count(*) as rides, round_even(quantile_cont(wait_time_min, 0.5), 4) as median_wait,
       round_even(avg(surge_multiplier), 4) as mean_surge,
       round_even((1 - avg(cast(is_completed as double))) * 100, 4) as cancel_pct,
       round_even(quantile_cont(fare_inr, 0.5), 4) as median_fare,
       cast(grouping(city) as integer) as is_total
from feat group by rollup(city)"""))
def q_kpi_cards(spark, sf):
    return E.kpi_cards(_feat(spark, sf))


@register("kpi_by_weather", on_feat("""
select weather, round_even(quantile_cont(wait_time_min, 0.5), 4) as median_wait,
       round_even(avg(surge_multiplier), 4) as mean_surge, cast(grouping(weather) as integer) as is_total
from feat group by rollup(weather)"""))
def q_kpi_by_weather(spark, sf):
    return E.kpi_by_weather(_feat(spark, sf))


@register("surge_histogram", on_raw("""
select g.bin, round_even(b.lo + (g.bin - 1) * (b.hi - b.lo) / 30.0, 6) as bin_lo,
       round_even(b.lo + g.bin * (b.hi - b.lo) / 30.0, 6) as bin_hi, coalesce(c.rides, 0) as rides
from (select cast(range as integer) as bin from range(1, 31)) g
cross join (select min(surge_multiplier) as lo, max(surge_multiplier) as hi from rides) b
left join (
  select case when b2.hi = b2.lo then 1
              else least(cast(floor((surge_multiplier - b2.lo) / ((b2.hi - b2.lo) / 30.0)) as integer) + 1, 30) end as bin,
         count(*) as rides
  from rides, (select min(surge_multiplier) as lo, max(surge_multiplier) as hi from rides) b2
  where surge_multiplier is not null group by 1) c on g.bin = c.bin"""))
def q_surge_histogram(spark, sf):
    return E.surge_histogram(S.raw(spark, sf))


@register("high_surge_share", on_feat("""
select count(*) filter (where surge_multiplier >= 2.0) as high_surge_rides,
       round_even(avg(cast(surge_multiplier >= 2.0 as double)) * 100, 4) as high_surge_pct
from feat"""))
def q_high_surge_share(spark, sf):
    return E.high_surge_share(_feat(spark, sf))


@register("head_sample", on_feat("select * from feat order by ts, ride_id limit 3"))
def q_head_sample(spark, sf):
    return E.head_sample(_feat(spark, sf))


@register("city_rides_ratio", on_feat("""
select city, rides, round_even(rides / max(rides) over (), 4) as ratio_to_max
from (select city, count(*) as rides from feat group by city)"""))
def q_city_rides_ratio(spark, sf):
    return E.city_rides_ratio(_feat(spark, sf))


@register("surge_breakdown_leftclosed", on_raw("""
select * from (values (0, 'No surge (1×)'), (1, 'Low (1–1.5×)'), (2, 'Med (1.5–2×)'),
                      (3, 'High (2–2.5×)'), (4, 'Extreme (>2.5×)')) t(band_order, band)
join (
  select 0 as k, round_even(avg(cast(surge_multiplier >= 1.0 and surge_multiplier < 1.01 as double)) * 100, 1) as pct from rides
  union all select 1, round_even(avg(cast(surge_multiplier >= 1.01 and surge_multiplier < 1.5 as double)) * 100, 1) from rides
  union all select 2, round_even(avg(cast(surge_multiplier >= 1.5 and surge_multiplier < 2.0 as double)) * 100, 1) from rides
  union all select 3, round_even(avg(cast(surge_multiplier >= 2.0 and surge_multiplier < 2.5 as double)) * 100, 1) from rides
  union all select 4, round_even(avg(cast(surge_multiplier >= 2.5 and surge_multiplier < 4.1 as double)) * 100, 1) from rides
) p on p.k = t.band_order""".replace("select * from", "select band_order::integer as band_order, band, pct from")))
def q_surge_breakdown(spark, sf):
    return D.surge_breakdown_leftclosed(S.raw(spark, sf))


# ---------------------------------------------------------------------------
# A / B / C: sources, validation, cleaning counters
# ---------------------------------------------------------------------------

from ridewise.operators import quality as Q  # noqa: E402
from ridewise.sources import readers as RD  # noqa: E402


@register("load_summary", on_raw("""
select count(*) as rows, 14 as columns, cast(min(ts) as date) as first_date, cast(max(ts) as date) as last_date
from rides""".replace("14 as columns", "cast(14 as integer) as columns")))
def q_load_summary(spark, sf):
    return RD.load_summary(S.raw(spark, sf))


@register("invalid_categories", on_raw("""
select distinct 'city' as "column", city as value from rides
  where not coalesce(city in ('Delhi NCR','Mumbai','Bengaluru','Chennai','Hyderabad'), false)
union all
select distinct 'vehicle_type', vehicle_type from rides
  where not coalesce(vehicle_type in ('bike_taxi','auto','economy','premium','shared'), false)
union all
select distinct 'weather', weather from rides
  where not coalesce(weather in ('clear','light_rain','heavy_rain','fog'), false)"""))
def q_invalid_categories(spark, sf):
    return Q.invalid_categories(S.raw(spark, sf))


_RAW_COLS = ["ride_id", "ts", "city", "pickup_zone", "vehicle_type", "wait_time_min", "surge_multiplier",
             "distance_km", "fare_inr", "driver_rating", "is_completed", "weather", "is_festival", "is_ipl_day"]
_NULL_UNION = " union all ".join(
    f"select '{c}' as \"column\", count(*) filter (where {c} is null) as null_count, count(*) as n from rides"
    for c in _RAW_COLS)


@register("null_profile", on_raw(f"""
select "column", null_count, round_even(null_count * 100.0 / n, 4) as null_pct
from ({_NULL_UNION}) where null_count > 0"""))
def q_null_profile(spark, sf):
    return Q.null_profile(S.raw(spark, sf))


_PROFILE_UNION = " union all ".join(
    f"select '{c}' as \"column\", '{t}' as dtype, count(*) filter (where {c} is null) as null_count, "
    f"count(*) as n, count(distinct {c}) as distinct_count from rides"
    for c, t in zip(_RAW_COLS, ["string", "timestamp_ntz", "string", "string", "string", "double", "double",
                                "double", "double", "double", "boolean", "string", "boolean", "boolean"]))


@register("column_profile", on_raw(f"""
select "column", dtype, null_count, round_even(null_count * 100.0 / n, 4) as null_pct, distinct_count
from ({_PROFILE_UNION})"""))
def q_column_profile(spark, sf):
    return Q.column_profile(S.raw(spark, sf))


@register("outlier_counts", on_raw("""
select count(*) filter (where fare_inr < 10 or fare_inr > 5000) as fare_inr,
       count(*) filter (where distance_km < 0.5 or distance_km > 80) as distance_km,
       count(*) filter (where wait_time_min > 120) as wait_time_min
from rides"""))
def q_outlier_counts(spark, sf):
    return Q.outlier_counts(S.raw(spark, sf))


@register("fare_outliers", on_raw("""
select count(*) filter (where fare_inr <= 0 or fare_inr > 5000) as fare_outliers from rides"""))
def q_fare_outliers(spark, sf):
    return Q.fare_outliers(S.raw(spark, sf))


@register("duplicate_count", on_raw("""
select cast(coalesce(sum(c - 1), 0) as bigint) as duplicates
from (select count(*) as c from rides group by city, ts, vehicle_type, distance_km)"""))
def q_duplicate_count(spark, sf):
    with bounded_tasks(spark):                       # a task counts the keys of one split in memory
        return cut_lineage(Q.duplicate_count_df(S.raw(spark, sf)), "duplicates")


_CHECKS_SQL = """
o_m as (
  select count(*) as n,
    count(*) filter (where not coalesce(city in ('Delhi NCR','Mumbai','Bengaluru','Chennai','Hyderabad'), false))
      + (5 - count(distinct city) filter (where city in ('Delhi NCR','Mumbai','Bengaluru','Chennai','Hyderabad'))) as city_set,
    cast(strftime(min(cast(ts as date)), '%Y%m%d') as double) as min_date,
    cast(strftime(max(cast(ts as date)), '%Y%m%d') as double) as max_date,
    quantile_cont(wait_time_min, 0.5) as med_wait, avg(surge_multiplier) as mean_surge,
    quantile_cont(fare_inr, 0.5) as med_fare, avg(cast(is_completed as double)) * 100 as completion,
    quantile_cont(driver_rating, 0.5) as med_rating,
    count(*) filter (where not coalesce(vehicle_type in ('bike_taxi','auto','economy','premium','shared'), false))
      + (5 - count(distinct vehicle_type) filter (where vehicle_type in ('bike_taxi','auto','economy','premium','shared'))) as vehicle_set,
    count(*) filter (where not coalesce(weather in ('clear','light_rain','heavy_rain','fog'), false)) as weather_subset,
    avg(cast(coalesce(weather = 'clear', false) as double)) * 100 as clear_pct,
    count(*) filter (where wait_time_min is null) as null_wait,
    count(*) filter (where driver_rating is null) as null_rating,
    count(*) filter (where pickup_zone is null) as null_zone,
    count(*) filter (where fare_inr <= 0 or fare_inr > 5000) as fare_outliers,
    avg(cast(hour(ts) in (7,8,9,17,18,19) as double)) * 100 as peak_pct,
    count(*) filter (where is_festival) as festival_rides,
    count(*) filter (where is_ipl_day) as ipl_rides,
    (select coalesce(sum(c - 1), 0) from (select count(*) as c from rides group by city, ts, vehicle_type, distance_km)) as dupes
  from rides),
o_checks as (
  select * from (values
    (1, 'all_columns_present', 'FAIL'), (2, 'row_count', 'FAIL'), (3, 'city_set', 'FAIL'),
    (4, 'first_date', 'FAIL'), (5, 'last_date', 'FAIL'), (6, 'median_wait', 'FAIL'),
    (7, 'mean_surge', 'FAIL'), (8, 'median_fare', 'FAIL'), (9, 'completion_pct', 'FAIL'),
    (10, 'median_rating', 'FAIL'), (11, 'vehicle_set', 'FAIL'), (12, 'weather_subset', 'FAIL'),
    (13, 'clear_share_pct', 'WARN'), (14, 'null_wait_present', 'WARN'), (15, 'null_rating_present', 'WARN'),
    (16, 'null_zone_present', 'WARN'), (17, 'fare_outliers_present', 'WARN'), (18, 'duplicates_present', 'WARN'),
    (19, 'peak_share_pct', 'FAIL'), (20, 'festival_rides_present', 'WARN'), (21, 'ipl_rides_present', 'WARN')
  ) t(check_id, check_name, severity)),
o_obs as (
  select c.check_id, c.check_name, c.severity,
    case c.check_id when 1 then 0.0 when 2 then n when 3 then city_set when 4 then min_date when 5 then max_date
      when 6 then med_wait when 7 then mean_surge when 8 then med_fare when 9 then completion
      when 10 then med_rating when 11 then vehicle_set when 12 then weather_subset when 13 then clear_pct
      when 14 then null_wait when 15 then null_rating when 16 then null_zone when 17 then fare_outliers
      when 18 then dupes when 19 then peak_pct when 20 then festival_rides else ipl_rides end as obs,
    case c.check_id when 1 then true when 2 then n >= @MINROWS@ when 3 then city_set = 0
      when 4 then min_date <= 20230131 when 5 then max_date >= 20240601
      when 6 then med_wait between 4 and 12 when 7 then mean_surge between 1 and 2
      when 8 then med_fare between 80 and 400 when 9 then completion between 80 and 97
      when 10 then med_rating between 3.5 and 4.8 when 11 then vehicle_set = 0 when 12 then weather_subset = 0
      when 13 then clear_pct between 50 and 85 when 14 then null_wait > 0 when 15 then null_rating > 0
      when 16 then null_zone > 0 when 17 then fare_outliers > 0 when 18 then dupes > 0
      when 19 then peak_pct between 15 and 70 when 20 then festival_rides > 0 else ipl_rides > 0 end as ok
  from o_checks c, o_m)"""

_CHECKS_SELECT = """
select cast(check_id as integer) as check_id, check_name, round_even(cast(obs as double), 4) as observed, severity,
       case when coalesce(ok, false) then 'PASS' else severity end as status
from o_obs"""


@register("quality_checks", on_raw(_CHECKS_SELECT, _CHECKS_SQL.replace("@MINROWS@", "490000")))
def q_quality_checks(spark, sf):
    return Q.quality_checks(S.raw(spark, sf))


@register("quality_verdict", on_raw("""
select count(*) filter (where status = 'FAIL') as failures, count(*) filter (where status = 'WARN') as warnings,
       count(*) filter (where status = 'PASS') as passed,
       cast(case when count(*) filter (where status = 'FAIL') > 0 then 1 else 0 end as integer) as exit_code
from (""" + _CHECKS_SELECT + ")", _CHECKS_SQL.replace("@MINROWS@", "490000")))
def q_quality_verdict(spark, sf):
    return Q.quality_verdict(Q.quality_checks(S.raw(spark, sf)))


_CLEANING_SELECT = """
select (select count(*) from rides) as rows_before,
       (select count(*) from rides) - (select count(*) from o_dedup) as duplicates_removed,
       (select count(*) from o_dedup) - (select count(*) from o_valid) as invalid_categoricals_removed,
       (select count(*) filter (where wait_time_min is null) from o_valid) as wait_time_imputed,
       (select count(*) filter (where driver_rating is null) from o_valid) as driver_rating_imputed,
       (select count(*) filter (where pickup_zone is null) from o_valid) as pickup_zone_imputed,
       (select count(*) filter (where fare_inr < 10 or fare_inr > 5000) from o_z1) as fare_outliers_capped,
       (select count(*) filter (where distance_km < 0.5 or distance_km > 80) from o_z1) as distance_outliers_capped,
       (select count(*) filter (where wait_time_min > 120) from o_z1) as wait_outliers_capped,
       (select count(*) filter (where ride_id is null) + count(*) filter (where ts is null)
             + count(*) filter (where city is null) + count(*) filter (where pickup_zone is null)
             + count(*) filter (where vehicle_type is null) + count(*) filter (where wait_time_min is null)
             + count(*) filter (where surge_multiplier is null) + count(*) filter (where distance_km is null)
             + count(*) filter (where fare_inr is null) + count(*) filter (where driver_rating is null)
             + count(*) filter (where is_completed is null) + count(*) filter (where weather is null)
             + count(*) filter (where is_festival is null) + count(*) filter (where is_ipl_day is null) from clean)
         as remaining_nulls,
       (select count(*) from clean) as rows_after,
       (select count(*) from rides) - (select count(*) from clean) as rows_removed"""


@register("cleaning_report", on_clean(_CLEANING_SELECT))
def q_cleaning_report(spark, sf):
    return S.cleaning(spark, sf)


@register("remaining_nulls", on_clean("""
select cast(sum((ride_id is null)::int + (ts is null)::int + (city is null)::int + (pickup_zone is null)::int
  + (vehicle_type is null)::int + (wait_time_min is null)::int + (surge_multiplier is null)::int
  + (distance_km is null)::int + (fare_inr is null)::int + (driver_rating is null)::int
  + (is_completed is null)::int + (weather is null)::int + (is_festival is null)::int
  + (is_ipl_day is null)::int) as bigint) as remaining_nulls from clean"""))
def q_remaining_nulls(spark, sf):
    return CL.remaining_nulls(S.clean(spark, sf))


# ---------------------------------------------------------------------------
# D extras and E: reports
# ---------------------------------------------------------------------------

from ridewise.operators import reports as R  # noqa: E402
from ridewise.functions.columns import round_np as _rn  # noqa: E402

_STAT_UNION = " union all ".join(
    f"select '{c}' as \"column\", round_even(avg({c}), 3) as mean, round_even(quantile_cont({c}, 0.5), 3) as median, "
    f"round_even(stddev_samp({c}), 3) as std, round_even(min({c}), 3) as min, round_even(max({c}), 3) as max "
    f"from (select cast({c} as double) as {c} from feat)" for c in R.STAT_COLUMNS)


@register("final_stats", on_feat(_STAT_UNION))
def q_final_stats(spark, sf):
    return R.final_stats(_feat(spark, sf))


_DESC_UNION = " union all ".join(
    f"select '{c}' as \"column\", cast(count({c}) as double) as count, round_even(avg({c}), 4) as mean, "
    f"round_even(stddev_samp({c}), 4) as std, min({c}) as min, round_even(quantile_cont({c}, 0.25), 4) as p25, "
    f"round_even(quantile_cont({c}, 0.5), 4) as p50, round_even(quantile_cont({c}, 0.75), 4) as p75, "
    f"max({c}) as max from feat" for c in R.DESCRIBE_COLUMNS)


@register("describe_numeric", on_feat(_DESC_UNION))
def q_describe_numeric(spark, sf):
    return R.describe_numeric(_feat(spark, sf))


_DIST_UNION = " union all ".join(
    f"select '{c}' as feature, cast({c} as varchar) as value, count(*) as count from feat "
    f"where {c} is not null group by {c}" for c in R.DIST_COLUMNS)


@register("feature_distributions", on_feat(_DIST_UNION))
def q_feature_distributions(spark, sf):
    return R.feature_distributions(_feat(spark, sf))


_DIMENSIONS = " union all ".join(f"select '{c}' as section, {c} as name, count(*) as rows from rides group by {c}" for c in ("city", "vehicle_type"))
_SHARES = f"""select section, name, rows, round_even(rows * 100.0 / (select count(*) from rides), 4) as pct
from ({_DIMENSIONS}) where name is not null"""


@register("value_counts_share", on_feat("""
select feature, value, count, round_even(count * 100.0 / sum(count) over (partition by feature), 4) as pct
from (select 'city' as feature, city as value, count(*) as count from feat group by city
      union all select 'vehicle_type', vehicle_type, count(*) from feat group by vehicle_type)"""))
def q_value_counts_share(spark, sf):
    return R.value_counts_share(_feat(spark, sf))


@register("raw_summary", on_raw(f"""{_SHARES}
union all select 'nulls', "column", null_count, round_even(null_count * 100.0 / n, 4) from ({_NULL_UNION}) where null_count > 0"""))
def q_raw_summary(spark, sf):
    """E7's rows by city, vehicle type and column with nulls."""
    return R.raw_summary(S.raw(spark, sf))


_FLAG_UNION = " union all ".join(
    f"select '{f}' as flag, round_even(avg(cast({f} as double)), 4) as rate from feat" for f in R.FLAG_COLUMNS)


@register("flag_rates", on_feat(_FLAG_UNION))
def q_flag_rates(spark, sf):
    return R.flag_rates(_feat(spark, sf))


@register("dataset_summary", on_raw("""
select count(*) as rows, min(cast(ts as date)) as first_date, max(cast(ts as date)) as last_date,
       round_even(quantile_cont(fare_inr, 0.5), 4) as median_fare,
       round_even(quantile_cont(wait_time_min, 0.5), 4) as median_wait,
       round_even(avg(surge_multiplier), 4) as mean_surge,
       round_even(avg(cast(is_completed as double)) * 100, 4) as completion_pct,
       count(*) filter (where is_festival) as festival_rides,
       round_even(avg(cast(is_festival as double)) * 100, 4) as festival_pct,
       count(*) filter (where is_ipl_day) as ipl_rides,
       round_even(avg(cast(is_ipl_day as double)) * 100, 4) as ipl_pct,
       count(*) filter (where fare_inr <= 0 or fare_inr > 5000) as outlier_fares
from rides"""))
def q_dataset_summary(spark, sf):
    return R.dataset_summary(S.raw(spark, sf))


@register("quality_report")
def q_quality_report(spark, sf):
    enr = _feat(spark, sf)
    return R.quality_report(enr, validation=Q.validation_issues(S.raw(spark, sf)),
                            cleaning=S.cleaning(spark, sf),
                            encodings=D.encoding_maps(enr))


@register("cyclical_encode", on_feat("""
select ride_id, round_even(sin(2 * pi() * hour / 24.0), 6) as hour_sin, round_even(cos(2 * pi() * hour / 24.0), 6) as hour_cos,
       round_even(sin(2 * pi() * day_of_week / 7.0), 6) as dow_sin, round_even(cos(2 * pi() * day_of_week / 7.0), 6) as dow_cos
from feat"""))
def q_cyclical(spark, sf):
    cyc = D.cyclical()
    return _feat(spark, sf).select("ride_id", *[_rn(v, 6).alias(k) for k, v in cyc.items()])


@register("label_codes", on_feat("""
select distinct 'city' as "column", city as value, city_code as code from feat
union all select distinct 'vehicle_type', vehicle_type, vehicle_code from feat
union all select distinct 'weather', weather, weather_code from feat
union all select * from (values ('season', 'winter', 0), ('season', 'summer', 1), ('season', 'monsoon', 2),
                                 ('season', 'post_monsoon', 3)) t(c, v, k)""".replace(
    "t(c, v, k)", "t(c, v, k)").replace("union all select * from (values", "union all select c, v, cast(k as integer) from (values")))
def q_label_codes(spark, sf):
    enr = _feat(spark, sf)
    return D.encoding_maps(enr).select("column", F.explode("codes").alias("value", "code"))


@register("calendar_enrich", on_clean("""
select ride_id, is_festival, is_ipl_day from clean"""))
def q_calendar_enrich(spark, sf):
    """Recompute both calendar flags from the calendars and the timestamps alone."""
    c = S.clean(spark, sf).select("ride_id", "ts", "city")
    return D.calendar_enrich(c).select("ride_id", "is_festival", "is_ipl_day")


_HOUR_DEMAND = ", ".join(f"({h}, {v})" for h, v in __import__("ridewise.config", fromlist=["x"]).HOUR_DEMAND.items())


@register("demand_multiplier", on_feat(f"""
select f.ride_id, round_even(cast(hd.m as double) * case when f.day_of_week >= 5 and f.hour between 18 and 23
                                    then 0.85::double * 1.25::double
                                    when f.day_of_week >= 5 then 0.85::double else 1.0::double end
        * case f.weather when 'clear' then 1.0::double when 'light_rain' then 1.35::double
                         when 'heavy_rain' then 1.75::double when 'fog' then 1.2::double end, 6) as demand_multiplier
from feat f join (select * from (values {_HOUR_DEMAND}) t(h, m)) hd on f.hour = hd.h"""))
def q_demand_multiplier(spark, sf):
    return _feat(spark, sf).select("ride_id", _rn(D.demand_multiplier(), 6).alias("demand_multiplier"))


@register("expected_fare", on_feat("""
select ride_id, round_even(e, 4) as expected_fare, round_even(fare_inr / e, 4) as fare_ratio
from (select ride_id, fare_inr, (case vehicle_type when 'bike_taxi' then 25.0 when 'auto' then 30.0
        when 'economy' then 50.0 when 'premium' then 100.0 when 'shared' then 20.0 end
      + case vehicle_type when 'bike_taxi' then 8.0 when 'auto' then 11.0 when 'economy' then 14.0
        when 'premium' then 22.0 when 'shared' then 6.0 end * distance_km) * surge_multiplier as e from feat)"""))
def q_expected_fare(spark, sf):
    e = D.expected_fare()
    return _feat(spark, sf).select("ride_id", _rn(e, 4).alias("expected_fare"),
                                   _rn(F.col("fare_inr") / e, 4).alias("fare_ratio"))


@register("snap_to_step", on_feat("""
select ride_id, round_even(surge_multiplier / 0.25, 0) * 0.25 as surge_snapped,
       round_even(driver_rating / 0.5, 0) * 0.5 as rating_snapped from feat"""))
def q_snap(spark, sf):
    return _feat(spark, sf).select("ride_id", D.snap_to_step("surge_multiplier", 0.25).alias("surge_snapped"),
                                   D.snap_to_step("driver_rating", 0.5).alias("rating_snapped"))


@register("event_flags", on_feat(f"""
select ride_id, {_EVENT} as event_type, cast(not is_completed as integer) as is_cancelled,
       strftime(ts, '%Y-%m') as year_month from feat"""))
def q_event_flags(spark, sf):
    return _feat(spark, sf).select("ride_id", D.event_type().alias("event_type"),
                                   D.is_cancelled().alias("is_cancelled"), D.year_month().alias("year_month"))


# ---------------------------------------------------------------------------
# G: time series
# ---------------------------------------------------------------------------

from ridewise.operators import timeseries as G  # noqa: E402

_HOURLY_CTE = """
o_h as (
  select city, date, hour, count(*) as rides, max(is_peak_hour) as is_peak_hour, max(is_weekend) as is_weekend,
         max(season_code) as season_code, max(city_code) as city_code, max(month) as month,
         max(day_of_week) as day_of_week, max(quarter) as quarter, max(is_raining) as is_raining,
         max(is_heavy_rain) as is_heavy_rain, max(is_fog) as is_fog,
         max(cast(is_festival as integer)) as is_festival, max(cast(is_ipl_day as integer)) as is_ipl_day
  from feat group by city, date, hour),
o_lag as (
  select *, cast(lag(rides, 1) over w as double) as rides_lag_1d, cast(lag(rides, 7) over w as double) as rides_lag_7d,
         avg(rides) over (w rows between 3 preceding and 1 preceding) as rides_roll_3d,
         avg(rides) over (w rows between 7 preceding and 1 preceding) as rides_roll_7d
  from o_h window w as (partition by city, hour order by date)),
o_ds as (select * from o_lag where rides_lag_1d is not null and rides_lag_7d is not null),
o_split as (
  select *, case when row_number() over (partition by city order by date, hour)
                      <= floor(count(*) over (partition by city) * 0.8) then 'train' else 'test' end as role,
         row_number() over (partition by city order by date, hour) - 1 as row_index
  from o_ds)"""


def _demand_ds(spark, sf):
    return G.city_dataset(G.hourly_dataset(_feat(spark, sf)))


@register("hourly_dataset", on_feat("select * from o_h", _HOURLY_CTE))
def q_hourly_dataset(spark, sf):
    return G.hourly_dataset(_feat(spark, sf))


@register("lag_features", on_feat("""
select city, date, hour, rides, rides_lag_1d, rides_lag_7d, round_even(rides_roll_3d, 6) as rides_roll_3d,
       round_even(rides_roll_7d, 6) as rides_roll_7d from o_ds""", _HOURLY_CTE))
def q_lag_features(spark, sf):
    ds = G.lag_features(G.hourly_dataset(_feat(spark, sf)))
    return ds.select("city", "date", "hour", "rides", "rides_lag_1d", "rides_lag_7d",
                     _rn("rides_roll_3d", 6).alias("rides_roll_3d"), _rn("rides_roll_7d", 6).alias("rides_roll_7d"))


@register("city_dataset_rows", on_feat("""
select city, count(*) as rows, min(date) as first_date, max(date) as last_date,
       round_even(sum(rides_roll_7d), 4) as sum_roll_7d from o_ds group by city""", _HOURLY_CTE))
def q_city_dataset_rows(spark, sf):
    ds = _demand_ds(spark, sf)
    return ds.groupBy("city").agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"),
                                  F.max("date").alias("last_date"),
                                  _rn(F.sum("rides_roll_7d"), 4).alias("sum_roll_7d"))


@register("hourly_split", on_feat("select city, date, hour, role, row_index from o_split", _HOURLY_CTE))
def q_hourly_split(spark, sf):
    return G.hourly_split(_demand_ds(spark, sf)).select(
        "city", "date", "hour", "role", F.col("row_index").cast("long").alias("row_index"))


@register("split_periods", on_feat("""
select city, role, min(date) as first_date, max(date) as last_date, count(*) as rows
from o_split group by city, role""", _HOURLY_CTE))
def q_split_periods(spark, sf):
    return G.split_periods(G.hourly_split(_demand_ds(spark, sf)))


@register("fold_sizes", on_feat("""
select city, fold, sum(case when segment < fold then 1 else 0 end) as train_size,
       sum(case when segment = fold then 1 else 0 end) as val_size
from (select city, cast(case when pos < n - 5 * (n // 6) then 0
                             else floor((pos - (n - 5 * (n // 6))) / (n // 6)) + 1 end as integer) as segment
      from (select city, row_number() over (partition by city order by date, hour) - 1 as pos,
                   count(*) over (partition by city) as n from o_split where role = 'train')),
     (select cast(range as integer) as fold from range(1, 6))
group by city, fold""".replace("sum(case when segment < fold then 1 else 0 end)",
                               "cast(sum(case when segment < fold then 1 else 0 end) as bigint)")
                      .replace("sum(case when segment = fold then 1 else 0 end)",
                               "cast(sum(case when segment = fold then 1 else 0 end) as bigint)"), _HOURLY_CTE))
def q_fold_sizes(spark, sf):
    split = G.hourly_split(_demand_ds(spark, sf))
    return G.fold_sizes(G.hourly_folds(split.where(F.col("role") == "train")))


@register("last_n_at_hour", on_feat("""
select city, date, hour, rides from (
  select *, row_number() over (partition by city order by date desc) as r
  from o_split where role = 'test' and hour = 18) where r <= 30""", _HOURLY_CTE))
def q_last_n(spark, sf):
    return G.last_n_at_hour(G.hourly_split(_demand_ds(spark, sf))).select("city", "date", "hour", "rides")


@register("temporal_split_rides", on_feat("""
select ride_id, case when row_number() over (order by ts, ride_id) <= floor(count(*) over () * 0.8)
                     then 'train' else 'test' end as role from feat"""))
def q_temporal_split(spark, sf):
    return G.temporal_split(_feat(spark, sf).select("ride_id", "ts")).select("ride_id", "role")


@register("time_series_folds_rides", on_feat("""
select ride_id, cast(case when pos < n - 5 * (n // 6) then 0
                          else floor((pos - (n - 5 * (n // 6))) / (n // 6)) + 1 end as integer) as segment
from (select ride_id, row_number() over (order by ts, ride_id) - 1 as pos, count(*) over () as n from feat)"""))
def q_ts_folds(spark, sf):
    return G.time_series_folds(_feat(spark, sf).select("ride_id", "ts")).select("ride_id", "segment")


@register("order_by_time", on_feat("select ride_id, ts, city from feat order by ts, ride_id"))
def q_order_by_time(spark, sf):
    return G.order_by_time(_feat(spark, sf).select("ride_id", "ts", "city"))


# ---------------------------------------------------------------------------
# H (metrics), I (rebalancing), J (scoring) — model-free predictors so that
# every number is checkable: demand = 7-day rolling mean (baseline: 3-day),
# wait / surge / cancellation = the live page's rule estimates.
# ---------------------------------------------------------------------------

from ridewise.operators import metrics as H  # noqa: E402
from ridewise.operators import rebalance as I  # noqa: E402
from ridewise.operators import scoring as J  # noqa: E402

_RULE_SQL = """
  round_even(case weather when 'clear' then 7.5::double when 'light_rain' then 9.5::double
                  when 'heavy_rain' then 14.0::double when 'fog' then 10.5::double end
    * case when hour in (7,8,9,17,18,19,20) then 1.3::double else 1.0::double end
    * case when is_festival then 1.4::double else 1.0::double end
    * case when is_ipl_day and hour >= 21 then 1.6::double else 1.0::double end, 1) as rule_wait,
  least(round_even(case weather when 'clear' then 0.2::double when 'light_rain' then 0.4::double
                  when 'heavy_rain' then 0.75::double when 'fog' then 0.45::double end
    + case when hour in (7,8,9,17,18,19,20) then 0.15::double else 0.0::double end
    + case when is_festival then 0.2::double else 0.0::double end
    + case when is_ipl_day and hour >= 21 then 0.3::double else 0.0::double end, 2), 1.0::double) as rule_surge_prob"""

_SURGE_LABEL = ("case when {p} >= 0.8 then 'Extreme surge risk' when {p} >= 0.6 then 'High surge risk' "
                "when {p} >= 0.4 then 'Moderate risk' else 'Normal' end")

_RIDE_TEST_CTE = f"""
o_rt as (
  select *, {_RULE_SQL},
         case when row_number() over (order by ts, ride_id) <= floor(count(*) over () * 0.8)
              then 'train' else 'test' end as role
  from feat)"""


_RULES: dict = {}


def _ride_rules(spark, sf):
    """Rule estimates on every ride with the 80/20 role; the split boundary is
    located once per session and data folder, then reused as a literal key."""
    k = (spark.sparkContext.applicationId, sf)
    if k not in _RULES:
        _RULES[k] = G.temporal_split(J.rule_based_estimates(_feat(spark, sf)))
    return _RULES[k]


def _demand_test(spark, sf):
    split = G.hourly_split(_demand_ds(spark, sf))
    return split.where(F.col("role") == "test")


@register("regression_metrics_demand", on_feat("""
select city, round_even(avg(abs(rides - rides_roll_7d)), 3) as mae,
       round_even(sqrt(avg((rides - rides_roll_7d) * (rides - rides_roll_7d))), 3) as rmse,
       round_even(1 - sum((rides - rides_roll_7d) * (rides - rides_roll_7d)) / nullif(var_pop(rides) * count(rides), 0), 4) as r2,
       round_even(avg(case when rides > 0 then abs((rides - rides_roll_7d) / rides) end) * 100, 2) as mape,
       count(*) as n
from (select city, cast(rides as double) as rides, rides_roll_7d from o_split where role = 'test') group by city""",
                                                  _HOURLY_CTE))
def q_reg_metrics_demand(spark, sf):
    return H.regression_metrics(_demand_test(spark, sf), "rides", "rides_roll_7d", by=("city",))


@register("improvement_over_baseline", on_feat("""
select city, round_even(m_mae, 3) as model_mae, round_even(b_mae, 3) as baseline_mae,
       round_even((round_even(b_mae, 3) - round_even(m_mae, 3)) / nullif(round_even(b_mae, 3), 0) * 100, 2) as improvement_pct
from (select city, avg(abs(rides - rides_roll_7d)) as m_mae, avg(abs(rides - rides_roll_3d)) as b_mae
      from o_split where role = 'test' group by city)""", _HOURLY_CTE))
def q_improvement(spark, sf):
    t = _demand_test(spark, sf)
    m = H.regression_metrics(t, "rides", "rides_roll_7d", by=("city",)).select("city", F.col("mae").alias("model_mae"))
    b = H.regression_metrics(t, "rides", "rides_roll_3d", by=("city",)).select("city", F.col("mae").alias("baseline_mae"))
    return m.join(b, "city").withColumn("improvement_pct", H.improvement_over_baseline("model_mae", "baseline_mae"))


@register("residual_histogram_demand", on_feat("""
select g.bin, round_even(r.lo + (g.bin - 1) * (r.hi - r.lo) / 40.0, 6) as bin_lo,
       round_even(r.lo + g.bin * (r.hi - r.lo) / 40.0, 6) as bin_hi, coalesce(c.cnt, 0) as count,
       round_even(coalesce(c.cnt, 0) / (r.total * ((r.hi - r.lo) / 40.0)), 6) as density
from (select cast(range as integer) as bin from range(1, 41)) g,
     (select min(v) as lo, max(v) as hi, count(*) as total from o_res) r
left join (select case when r2.hi = r2.lo then 1
                       else least(cast(floor((v - r2.lo) / ((r2.hi - r2.lo) / 40.0)) as integer) + 1, 40) end as bin,
                  count(*) as cnt
           from o_res, (select min(v) as lo, max(v) as hi from o_res) r2 group by 1) c on g.bin = c.bin""",
                                                  _HOURLY_CTE + """,
o_res as (select cast(rides_roll_7d - rides as double) as v from o_split where role = 'test')"""))
def q_residual_hist(spark, sf):
    return H.residual_histogram(_demand_test(spark, sf), "rides", "rides_roll_7d", bins=40)


@register("residual_mean_demand", on_feat("""
select round_even(avg(rides_roll_7d - rides), 4) as mean_residual from o_split where role = 'test'""", _HOURLY_CTE))
def q_residual_mean(spark, sf):
    return H.residual_mean(_demand_test(spark, sf), "rides", "rides_roll_7d")


@register("target_stats_demand", on_feat("""
select city, round_even(avg(rides), 4) as mean, round_even(stddev_samp(rides), 4) as std
from o_split where role = 'train' group by city""", _HOURLY_CTE))
def q_target_stats(spark, sf):
    split = G.hourly_split(_demand_ds(spark, sf)).where(F.col("role") == "train")
    return split.groupBy("city").agg(_rn(F.avg("rides"), 4).alias("mean"), _rn(F.stddev_samp("rides"), 4).alias("std"))


_SCALE_COLS = list(G.DEMAND_FEATURES)


_SCALE_SQL = {"hour_sin": "sin(2 * pi() * hour / 24.0)", "hour_cos": "cos(2 * pi() * hour / 24.0)",
              "dow_sin": "sin(2 * pi() * day_of_week / 7.0)", "dow_cos": "cos(2 * pi() * day_of_week / 7.0)"}


@register("scaling_stats_demand", on_feat(" union all ".join(
    f"select '{c}' as \"column\", round_even(avg(cast({_SCALE_SQL.get(c, c)} as double)), 6) as mean, "
    f"round_even(stddev_pop(cast({_SCALE_SQL.get(c, c)} as double)), 6) as std from o_split where role = 'train'"
    for c in _SCALE_COLS), _HOURLY_CTE))
def q_scaling_stats(spark, sf):
    split = G.hourly_split(_demand_ds(spark, sf)).where(F.col("role") == "train")
    return H.scaling_stats(split, _SCALE_COLS)


@register("regression_metrics_wait", on_feat("""
select round_even(avg(abs(y - p)), 3) as mae, round_even(sqrt(avg((y - p) * (y - p))), 3) as rmse,
       round_even(1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(y), 0), 4) as r2,
       round_even(avg(case when y > 0 then abs((y - p) / y) end) * 100, 2) as mape, count(*) as n
from (select wait_time_min as y, rule_wait as p from o_rt where role = 'test')""", _RIDE_TEST_CTE))
def q_reg_metrics_wait(spark, sf):
    t = _ride_rules(spark, sf).where(F.col("role") == "test")
    return H.regression_metrics(t, "wait_time_min", "rule_wait")


@register("hourly_actual_vs_pred_wait", on_feat("""
select hour, round_even(avg(wait_time_min), 4) as actual, round_even(avg(rule_wait), 4) as predicted
from o_rt where role = 'test' group by hour""", _RIDE_TEST_CTE))
def q_hourly_avp(spark, sf):
    t = _ride_rules(spark, sf).where(F.col("role") == "test")
    return H.hourly_actual_vs_pred(t, "wait_time_min", "rule_wait")


@register("classification_metrics_surge", on_feat("""
select round_even(a.auc, 4) as auc,
       round_even(coalesce(tp / nullif(tp + fp, 0), 0), 4) as precision,
       round_even(coalesce(tp / nullif(tp + fn, 0), 0), 4) as recall,
       round_even(coalesce(2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0))
                  / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0), 0), 4) as f1
from (select cast(count(*) filter (where y = 1 and p = 1) as double) as tp,
             cast(count(*) filter (where y = 0 and p = 1) as double) as fp,
             cast(count(*) filter (where y = 1 and p = 0) as double) as fn from o_cls),
     (select sum(pos * (neg_below + neg / 2.0)) / (sum(pos) * sum(neg)) as auc from (
        select s, pos, neg, coalesce(sum(neg) over (order by s rows between unbounded preceding and 1 preceding), 0) as neg_below
        from (select s, count(*) filter (where y = 1) as pos, count(*) filter (where y = 0) as neg from o_cls group by s))) a""",
                                                     _RIDE_TEST_CTE + """,
o_cls as (select is_high_surge as y, cast(rule_surge_prob >= 0.5 as integer) as p, rule_surge_prob as s
          from o_rt where role = 'test')"""))
def q_cls_metrics(spark, sf):
    t = _ride_rules(spark, sf).where(F.col("role") == "test").withColumn(
        "pred", (F.col("rule_surge_prob") >= 0.5).cast("int"))
    return H.classification_metrics(t, "is_high_surge", "pred", "rule_surge_prob")


@register("confusion_matrix_surge", on_feat("""
select tn, fp, fn, tp, round_even(tn * 100.0 / (tn + fp + fn + tp), 2) as tn_pct,
       round_even(fp * 100.0 / (tn + fp + fn + tp), 2) as fp_pct, round_even(fn * 100.0 / (tn + fp + fn + tp), 2) as fn_pct,
       round_even(tp * 100.0 / (tn + fp + fn + tp), 2) as tp_pct
from (select count(*) filter (where y = 0 and p = 0) as tn, count(*) filter (where y = 0 and p = 1) as fp,
             count(*) filter (where y = 1 and p = 0) as fn, count(*) filter (where y = 1 and p = 1) as tp
      from (select is_high_surge as y, cast(rule_surge_prob >= 0.5 as integer) as p from o_rt where role = 'test'))""",
                                               _RIDE_TEST_CTE))
def q_confusion(spark, sf):
    t = _ride_rules(spark, sf).where(F.col("role") == "test").withColumn(
        "pred", (F.col("rule_surge_prob") >= 0.5).cast("int"))
    return H.confusion_matrix(t, "is_high_surge", "pred")


@register("class_balance_surge", on_feat("""
select round_even(avg(cast(is_high_surge as double)), 4) as positive_rate, count(*) as n
from o_rt where role = 'train'""", _RIDE_TEST_CTE))
def q_class_balance(spark, sf):
    return H.class_balance(_ride_rules(spark, sf).where(F.col("role") == "train"), "is_high_surge")


@register("class_balance_cancellation", on_feat("""
select round_even(avg(1 - cast(is_completed as double)), 4) as positive_rate, count(*) as n
from o_rt where role = 'train'""", _RIDE_TEST_CTE))
def q_class_balance_cancel(spark, sf):
    train = _ride_rules(spark, sf).where(F.col("role") == "train")
    return H.class_balance(train.withColumn("is_cancelled", D.is_cancelled()), "is_cancelled")


@register("target_stats_wait", on_feat("""
select round_even(avg(wait_time_min), 4) as mean, round_even(stddev_samp(wait_time_min), 4) as std
from o_rt where role = 'train'""", _RIDE_TEST_CTE))
def q_target_stats_wait(spark, sf):
    return H.target_stats(_ride_rules(spark, sf).where(F.col("role") == "train"), "wait_time_min")


@register("score_histogram_by_class", on_feat("""
select g.label, g.bin, round_even(r.lo + (g.bin - 1) * (r.hi - r.lo) / 40.0, 6) as bin_lo,
       round_even(r.lo + g.bin * (r.hi - r.lo) / 40.0, 6) as bin_hi, coalesce(c.cnt, 0) as count,
       round_even(coalesce(c.cnt, 0) / (r.total * ((r.hi - r.lo) / 40.0)), 6) as density
from (select label, cast(range as integer) as bin from (select distinct label from o_sc), range(1, 41)) g
join (select label, min(v) as lo, max(v) as hi, count(*) as total from o_sc group by label) r on g.label = r.label
left join (select o.label, case when r2.hi = r2.lo then 1
                       else least(cast(floor((v - r2.lo) / ((r2.hi - r2.lo) / 40.0)) as integer) + 1, 40) end as bin,
                  count(*) as cnt
           from o_sc o join (select label, min(v) as lo, max(v) as hi from o_sc group by label) r2 on o.label = r2.label
           group by 1, 2) c on g.label = c.label and g.bin = c.bin""", _RIDE_TEST_CTE + """,
o_sc as (select is_high_surge as label, rule_surge_prob as v from o_rt where role = 'test')"""))
def q_score_hist(spark, sf):
    t = _ride_rules(spark, sf).where(F.col("role") == "test")
    return H.score_histogram_by_class(t, "is_high_surge", "rule_surge_prob", bins=40)


_HOURS_AVG = ", ".join(f"coalesce(avg(case when hour = {h} then rule_surge_prob end), 0.0) as h{h:02d}"
                       for h in range(24))


def _risk_long(spark, sf):
    t = _ride_rules(spark, sf).where(F.col("role") == "test")
    long = I.unpivot_matrix(I.surge_risk_matrix(t, "rule_surge_prob"))
    codes = D.code_table(_feat(spark, sf), "city", "city_code")
    return I.decode_city(long, codes)


_RISK_LONG_CTE = _RIDE_TEST_CTE + """,
o_codes as (select distinct city, city_code from feat),
o_risk as (
  select c.city, m.city_code, m.hour, m.surge_prob from (
    select city_code, hour, coalesce(avg(rule_surge_prob), 0.0) as surge_prob
    from (select city_code from o_rt where role = 'test' group by city_code)
    cross join (select cast(range as integer) as hour from range(0, 24))
    left join (select city_code, hour, rule_surge_prob from o_rt where role = 'test') using (city_code, hour)
    group by city_code, hour) m left join o_codes c on m.city_code = c.city_code)"""


@register("surge_risk_matrix", on_feat(f"""
select city_code, {_HOURS_AVG.replace('avg(case', 'round_even(avg(case').replace('end), 0.0)', 'end), 6), 0.0)')}
from o_rt where role = 'test' group by city_code""", _RIDE_TEST_CTE))
def q_surge_risk_matrix(spark, sf):
    t = _ride_rules(spark, sf).where(F.col("role") == "test")
    m = I.surge_risk_matrix(t, "rule_surge_prob")
    return I.rounded(m, [f"h{h:02d}" for h in range(24)])


@register("surge_risk_long", on_feat("""
select city, city_code, hour, round_even(surge_prob, 6) as surge_prob from o_risk""", _RISK_LONG_CTE))
def q_surge_risk_long(spark, sf):
    return I.rounded(_risk_long(spark, sf), ["surge_prob"])


@register("rebalancing_top10", on_feat("""
select city, city_code, hour, round_even(surge_prob, 6) as surge_prob, city || ' ' || cast(hour as varchar) || ':00' as label
from o_risk order by surge_prob desc, city, hour limit 10""", _RISK_LONG_CTE))
def q_rebalancing_top10(spark, sf):
    return I.rounded(I.rebalancing_top(_risk_long(spark, sf)), ["surge_prob"])


@register("rule_based_estimates", on_feat(f"""
select ride_id, rule_wait, rule_surge_prob, {_SURGE_LABEL.format(p='rule_surge_prob')} as rule_surge_label,
       round_even(0.04::double + case when weather = 'heavy_rain' then 0.12::double else 0.0::double end
                  + case when rule_surge_prob >= 0.6 then 0.08::double else 0.0::double end, 2) as rule_cancel_prob,
       round_even(1.5::double + rule_surge_prob * 1.5::double, 2) as rule_demand_pressure,
       round_even(1.0::double + rule_surge_prob * 2.5::double, 2) as rule_surge_estimate,
       [case when rule_wait > 10 then 'High demand — pre-position fleet in ' || city else 'Normal demand conditions' end,
        case when rule_surge_prob >= 0.5 then 'Surge alert: ' || {_SURGE_LABEL.format(p='rule_surge_prob')} || ' — activate standby pool'
             else 'No surge action needed' end] as rule_advice
from (select *, {_RULE_SQL} from feat)"""))
def q_rule_based(spark, sf):
    r = J.rule_based_estimates(_feat(spark, sf))
    return r.select("ride_id", "rule_wait", "rule_surge_prob", "rule_surge_label", "rule_cancel_prob",
                    "rule_demand_pressure", "rule_surge_estimate", "rule_advice")


@register("rule_based_profile", on_feat("""
select city, month, day_of_week, weather, is_festival, is_ipl_day, hour,
       round_even(case weather when 'clear' then 7.5::double when 'light_rain' then 9.5::double
                  when 'heavy_rain' then 14.0::double when 'fog' then 10.5::double end
         * case when hour in (7,8,9,17,18,19,20) then 1.3::double when hour in (1,2,3,4) then 0.8::double else 1.0::double end
         * case when is_festival then 1.4::double else 1.0::double end, 1) as wait_time_min,
       round_even(least(case weather when 'clear' then 0.2::double when 'light_rain' then 0.4::double
                  when 'heavy_rain' then 0.7::double when 'fog' then 0.45::double end
         + case when hour in (7,8,9,17,18,19,20) then 0.15::double else 0.0::double end
         + case when is_festival then 0.2::double else 0.0::double end, 1.0::double) * 100, 1) as surge_risk_pct
from (select distinct city, month, day_of_week, weather, is_festival, is_ipl_day from feat),
     (select cast(range as integer) as hour from range(0, 24))"""))
def q_rule_profile(spark, sf):
    return J.rule_based_profile(J.scenario_keys(_feat(spark, sf)))


_RECS_SQL = """
  list_filter([
    case when w > 10 then 'Dispatch additional drivers to ' || city || ' — predicted wait '
         || cast(cast(round_even(w, 0) as bigint) as varchar) || ' min' end,
    case when hs then 'Surge alert (' || lbl || ') — pre-position fleet before ' || cast(hour as varchar) || ':00' end,
    case when weather = 'heavy_rain' then 'Heavy rain: activate rain surge protocol, expect 3× cancellations' end,
    case when is_festival then 'Festival day: deploy surge standby pool from 6 PM onwards' end,
    case when is_ipl_day and hour >= 21 then 'Post-IPL demand spike expected — activate 150+ standby vehicles' end],
    lambda x: x is not null)"""


@register("recommendations", on_feat(f"""
select ride_id, case when len(recs) = 0 then ['Demand is normal — maintain current fleet distribution'] else recs end
         as recommendations
from (select ride_id, {_RECS_SQL} as recs
      from (select *, rule_wait as w, rule_surge_prob >= 0.5 as hs, {_SURGE_LABEL.format(p='rule_surge_prob')} as lbl
            from (select *, {_RULE_SQL} from feat)))"""))
def q_recommendations(spark, sf):
    r = J.rule_based_estimates(_feat(spark, sf)).withColumns({
        "_hs": F.col("rule_surge_prob") >= 0.5})
    return r.select("ride_id", J.recommendations(wait="rule_wait", high_surge="_hs",
                                                 label="rule_surge_label").alias("recommendations"))


@register("recommendation_severity", on_feat(f"""
select ride_id, list_transform(r, lambda t: case when regexp_matches(lower(t), '(urgent|extreme|critical|alert|heavy)') then 'alarm'
                                          when regexp_matches(lower(t), '(surge|high|spike|festival)') then 'warning'
                                          else 'ok' end) as severity
from (select ride_id, case when len(recs) = 0 then ['Demand is normal — maintain current fleet distribution'] else recs end as r
      from (select ride_id, {_RECS_SQL} as recs
            from (select *, rule_wait as w, rule_surge_prob >= 0.5 as hs, {_SURGE_LABEL.format(p='rule_surge_prob')} as lbl
                  from (select *, {_RULE_SQL} from feat))))"""))
def q_rec_severity(spark, sf):
    r = J.rule_based_estimates(_feat(spark, sf)).withColumn("_hs", F.col("rule_surge_prob") >= 0.5)
    recs = J.recommendations(wait="rule_wait", high_surge="_hs", label="rule_surge_label")
    return r.select("ride_id", J.recommendation_severity(recs).alias("severity"))


@register("status_lights", on_feat("""
select ride_id,
  case when rule_surge_prob >= 0.7 then 'red' when rule_surge_prob >= 0.4 then 'amber' else 'green' end as surge_light,
  case when rule_wait >= 12 then 'red' when rule_wait >= 8 then 'amber' else 'green' end as wait_light,
  case when rule_wait < 6 then 'green' when rule_wait < 10 then 'amber' else 'red' end as wait_gauge,
  case when rule_surge_prob * 100 < 40 then 'green' when rule_surge_prob * 100 < 65 then 'amber' else 'red' end as surge_gauge,
  case when dp < 2 then 'green' when dp < 3 then 'amber' else 'red' end as pressure_gauge
from (select *, round_even(1.5::double + rule_surge_prob * 1.5::double, 2) as dp
      from (select *, """ + _RULE_SQL + " from feat))"))
def q_status_lights(spark, sf):
    r = J.status_lights(J.rule_based_estimates(_feat(spark, sf)))
    return r.select("ride_id", "surge_light", "wait_light", "wait_gauge", "surge_gauge", "pressure_gauge")


_SCEN_FEAT_SQL = """
select ride_id as scenario_id, hour, day_of_week, month, cast(floor((month - 1) / 3) + 1 as integer) as quarter,
  cast(hour in (7,8,9,17,18,19,20) as integer) as is_peak_hour, cast(day_of_week >= 5 as integer) as is_weekend,
  cast(hour in (22,23,0,1,2,3,4) as integer) as is_night, cast(weather in ('light_rain', 'heavy_rain') as integer) as is_raining,
  cast(weather = 'heavy_rain' as integer) as is_heavy_rain, cast(weather = 'fog' as integer) as is_fog,
  cast(is_festival as integer) as is_festival_i, cast(is_ipl_day as integer) as is_ipl_day_i,
  cast(surge_multiplier as double) as surge_multiplier, cast(hourly_ride_volume as double) as hourly_ride_volume,
  round_even(cast(surge_multiplier as double) + case when hour in (7,8,9,17,18,19,20) then 0.5::double else 0.0::double end
    + case when weather in ('light_rain', 'heavy_rain') then 0.4::double else 0.0::double end
    + case when is_festival then 0.6::double else 0.0::double end
    + case when is_ipl_day then 0.5::double else 0.0::double end, 2) as demand_pressure,
  cast(coalesce(case city when 'Bengaluru' then 0 when 'Chennai' then 1 when 'Delhi NCR' then 2
       when 'Hyderabad' then 3 when 'Mumbai' then 4 end, 2) as integer) as city_code,
  cast(coalesce(case vehicle_type when 'auto' then 0 when 'bike_taxi' then 1 when 'economy' then 2
       when 'premium' then 3 when 'shared' then 4 end, 2) as integer) as vehicle_code,
  cast(coalesce(case weather when 'clear' then 0 when 'fog' then 1 when 'heavy_rain' then 2
       when 'light_rain' then 3 end, 0) as integer) as weather_code,
  season_code, round_even(sin(2 * pi() * hour / 24.0), 6) as hour_sin, round_even(cos(2 * pi() * hour / 24.0), 6) as hour_cos,
  round_even(sin(2 * pi() * day_of_week / 7.0), 6) as dow_sin, round_even(cos(2 * pi() * day_of_week / 7.0), 6) as dow_cos,
  15.0::double as rides_lag_1d, 15.0::double as rides_lag_7d, 15.0::double as rides_roll_3d, 15.0::double as rides_roll_7d
from feat"""


@register("build_scenario_features", on_feat(_SCEN_FEAT_SQL))
def q_scenario_features(spark, sf):
    """The whole feature row of every request, defaults included."""
    f = J.build_scenario_features(J.scenarios_from_rides(_feat(spark, sf)))
    waves = ("hour_sin", "hour_cos", "dow_sin", "dow_cos")
    return f.select("scenario_id", "hour", "day_of_week", "month", "quarter", "is_peak_hour", "is_weekend", "is_night", "is_raining", "is_heavy_rain",
                    "is_fog", "is_festival_i", "is_ipl_day_i", "surge_multiplier", "hourly_ride_volume", "demand_pressure", "city_code", "vehicle_code",
                    "weather_code", "season_code", *(_rn(c, 6).alias(c) for c in waves), "rides_lag_1d", "rides_lag_7d", "rides_roll_3d", "rides_roll_7d")


@register("model_result_labels", on_feat(f"""
select ride_id, round_even(least(greatest(wait_time_min * 1.7::double - 1, 0.5), 60), 1) as wait_time_min,
  round_even(p, 3) as surge_probability, p >= 0.5 as surge_is_high, {_SURGE_LABEL.format(p='p')} as surge_label,
  round_even(1.0::double + p * 2.5::double, 2) as surge_estimate, round_even(c, 3) as cancel_probability,
  case when c >= 0.2 then 'High cancellation risk' when c >= 0.12 then 'Moderate risk' else 'Low risk' end as cancel_label
from (select *, least(cast(fare_inr as double) / 400, 1.0::double) as p, cast(wait_time_min as double) / 70 as c from feat)"""))
def q_model_result_labels(spark, sf):
    """J3-J5 behind the trees: clip, rounding, thresholds and labels over given predictions (unrounded)."""
    given = _feat(spark, sf).select("ride_id", (F.col("wait_time_min") * 1.7 - 1).alias("w"),
                                    F.least(F.col("fare_inr").cast("double") / 400, F.lit(1.0)).alias("p"), (F.col("wait_time_min").cast("double") / 70).alias("c"))
    r = given.select("ride_id", J.wait_result("w").alias("wait_time_min"), J.surge_result("p").alias("s"), J.cancel_result("c").alias("k"))
    return r.select("ride_id", "wait_time_min", F.col("s.probability").alias("surge_probability"), F.col("s.is_high_surge").alias("surge_is_high"),
                    F.col("s.label").alias("surge_label"), "s.surge_estimate", F.col("k.probability").alias("cancel_probability"), F.col("k.label").alias("cancel_label"))


@register("predict_all_fallback", on_feat(f"""
select scenario_id, city, hour, weather, vehicle_type, is_festival, is_ipl_day, 7.5::double as wait_time_min,
       0.3::double as surge_probability, false as surge_is_high, 'Normal' as surge_label,
       0.06::double as cancel_probability, 'Low risk' as cancel_label, demand_pressure,
       case when len(recs) = 0 then ['Demand is normal — maintain current fleet distribution'] else recs end as recommendations
from (select *, {_RECS_SQL} as recs from (
  select ride_id as scenario_id, city, hour, weather, vehicle_type, is_festival, is_ipl_day,
         7.5::double as w, false as hs, 'Normal' as lbl,
         round_even(cast(surge_multiplier as double) + case when hour in (7,8,9,17,18,19,20) then 0.5::double else 0.0::double end
           + case when weather in ('light_rain', 'heavy_rain') then 0.4::double else 0.0::double end
           + case when is_festival then 0.6::double else 0.0::double end
           + case when is_ipl_day then 0.5::double else 0.0::double end, 2) as demand_pressure
  from feat))"""))
def q_predict_all(spark, sf):
    r = J.predict_all(J.scenarios_from_rides(_feat(spark, sf)))
    return r.select("scenario_id", "city", "hour", "weather", "vehicle_type", "is_festival", "is_ipl_day",
                    "wait_time_min", F.col("surge.probability").alias("surge_probability"),
                    F.col("surge.is_high_surge").alias("surge_is_high"), F.col("surge.label").alias("surge_label"),
                    F.col("cancellation.probability").alias("cancel_probability"),
                    F.col("cancellation.label").alias("cancel_label"), "demand_pressure", "recommendations")


@register("hourly_profile_fallback", on_feat("""
select city, month, day_of_week, weather, is_festival, is_ipl_day, hour, 7.5::double as wait_time_min,
       0.3::double as surge_prob, 'Normal' as surge_label, 0.06::double as cancel_prob,
       round_even(1.5::double + case when hour in (7,8,9,17,18,19,20) then 0.5::double else 0.0::double end
           + case when weather in ('light_rain', 'heavy_rain') then 0.4::double else 0.0::double end
           + case when is_festival then 0.6::double else 0.0::double end
           + case when is_ipl_day then 0.5::double else 0.0::double end, 2) as demand_pressure
from (select distinct city, month, day_of_week, weather, is_festival, is_ipl_day from feat),
     (select cast(range as integer) as hour from range(0, 24))"""))
def q_hourly_profile(spark, sf):
    keys = J.scenario_keys(_feat(spark, sf))
    p = J.hourly_profile(keys.withColumn("hour", F.lit(0)))
    return p.select("city", "month", "day_of_week", "weather", "is_festival", "is_ipl_day", "hour",
                    "wait_time_min", "surge_prob", "surge_label", "cancel_prob", "demand_pressure")


# ---------------------------------------------------------------------------
# H (MLlib models), A8/A9, J3–J5, J11, J13, J14 — rows-only checks.
# All models are trained once per session and data folder, at full length.
# ---------------------------------------------------------------------------

from ridewise.operators import boosting as B  # noqa: E402
from ridewise.operators import models as ML  # noqa: E402
from ridewise.plans import training as T  # noqa: E402


_SPLITS: dict = {}
_TRAIN_LOCK = threading.RLock()

#: Training jobs and the models each stores (demand: one a city).
_STORES = {"wait": ["wait_time"], "surge": ["surge"], "cancellation": ["cancellation"],
           "demand": [f"demand_{c.replace(' ', '_')}" for c in C.VALID_CITIES]}


def _ride_split(spark, sf):
    k = ("ride_split", spark.sparkContext.applicationId, sf)
    with _TRAIN_LOCK:
        if k not in _SPLITS:
            _SPLITS[k] = T.ride_split(_feat(spark, sf))
        return _SPLITS[k]


def _entries(spark, sf, *jobs):
    """Registry entries of the named training jobs' models (of all without a name).

    Entries are read from the shared folder; a job runs only where one of its
    models has no entry there. Jobs still to run are independent and run together.
    """
    path, jobs = S.model_path(spark, sf, T.PARAMETERS), jobs or tuple(_STORES)
    wanted = [m for j in jobs for m in _STORES[j]]
    with _TRAIN_LOCK:
        there = {r["name"] for r in ML.registry(spark, path, wanted).select("name").collect()}       # a few names
        todo = [j for j in jobs if not there.issuperset(_STORES[j])]
        if todo:
            run = T.model_jobs(spark, _feat(spark, sf), _ride_split(spark, sf), path)
            with ThreadPoolExecutor(max_workers=len(todo)) as pool:
                for job in [pool.submit(run[n]) for n in todo]:
                    job.result()
    return ML.registry(spark, path, wanted)


def _stored(spark, sf, name):
    """A stored model, read again; a missing one is an error here."""
    model = ML.load_model(S.model_path(spark, sf, T.PARAMETERS), name)
    if model is None:
        raise FileNotFoundError(f"no stored model {name}")
    return model


def _metric_rows(entries, *metrics):
    rows = ML.stored_metrics(entries)
    return rows.select(*(F.col("metrics")[m].cast("long" if m == "n" else "double").alias(m) for m in metrics), F.lit("all").alias("scope"), "model")


@register("gbt_demand_leaderboard")
def q_demand_models(spark, sf):
    return ML.leaderboard(_entries(spark, sf, "demand"))


@register("gbt_wait_metrics")
def q_wait_model(spark, sf):
    return _metric_rows(_entries(spark, sf, "wait"), "mae", "rmse", "r2", "mape", "n")


@register("gbt_surge_metrics")
def q_surge_model(spark, sf):
    return _metric_rows(_entries(spark, sf, "surge"), "auc", "precision", "recall", "f1")


@register("gbt_cancel_metrics")
def q_cancel_model(spark, sf):
    return _metric_rows(_entries(spark, sf, "cancellation"), "auc", "precision", "recall", "f1")


@register("gbt_surge_leak_free_metrics")
def q_surge_leak_free(spark, sf):
    """Surge classifier without demand_pressure (which contains the surge itself)."""
    met, _, _ = T.train_classifier(spark, _ride_split(spark, sf), "is_high_surge", ML.LEAK_FREE_SURGE_FEATURES,
                                   T.SURGE_GBT, name="surge_leak_free", baseline=False)
    return met


@register("gbt_surge_weighted_metrics")
def q_surge_weighted(spark, sf):
    """H7 with the class weight, without the leaking feature (with it every model is perfect)."""
    met, _, _ = T.train_classifier(spark, _ride_split(spark, sf), "is_high_surge", ML.LEAK_FREE_SURGE_FEATURES,
                                   T.SURGE_GBT, name="surge_weighted", baseline=False, balanced=True)
    return met


@register("class_weight_surge", on_feat("""
select label, round_even(case when label = 1 then (1 - p) / p else 1.0::double end, 6) as class_weight, count(*) as rows
from (select is_high_surge as label, avg(cast(is_high_surge as double)) over () as p from o_rt where role = 'train') group by label, p""", _RIDE_TEST_CTE))
def q_class_weight(spark, sf):
    train = T.class_weighted(_ride_split(spark, sf).where(F.col("role") == "train"), "is_high_surge")
    return train.groupBy(F.col("is_high_surge").alias("label"), _rn("class_weight", 6).alias("class_weight")).agg(F.count(F.lit(1)).alias("rows"))


@register("model_leaderboard")
def q_leaderboard(spark, sf):
    """H19 over the regressors: demand by city and on average, wait; gain over the baseline."""
    return ML.leaderboard(_entries(spark, sf))


@register("classifier_leaderboard")
def q_classifier_leaderboard(spark, sf):
    """H19 over the classifiers: surge with its baseline, cancellation."""
    rows = ML.stored_metrics(_entries(spark, sf, "surge", "cancellation"))
    return rows.select("name", "model", *(F.col("metrics")[m].alias(m) for m in ("auc", "precision", "recall", "f1")))


@register("feature_importance_wait")
def q_importance(spark, sf):
    return ML.feature_importance(_entries(spark, sf, "wait"), k=12).select("feature", "importance")


@register("feature_importances")
def q_importances(spark, sf):
    """H15 for every stored model: wait, surge, cancellation, demand by city."""
    return ML.feature_importance(_entries(spark, sf))


def _ride_folds(spark, sf):
    """Training rides with the fold they validate."""
    return G.time_series_folds(_ride_split(spark, sf).where(F.col("role") == "train"))


def _demand_folds(spark, sf):
    return G.hourly_folds(G.hourly_split(_demand_ds(spark, sf)).where(F.col("role") == "train"))


def _validated(spark, sf, name, make):
    """A model's walk-forward scores from the registry; where they are not stored yet, ``make`` computes them."""
    path = S.model_path(spark, sf, T.PARAMETERS)
    with _TRAIN_LOCK:
        scores = ML.stored_folds(spark, path, name)
        if scores is None:
            ML.store_folds(make(), path, name)
            scores = ML.stored_folds(spark, path, name)
    return scores


@register("cv_scores_wait")
def q_cv_wait(spark, sf):
    """Walk-forward folds of the wait model; mean and std of the folds' MAE beside them."""
    return _validated(spark, sf, "wait_time", lambda: B.cv_scores(
        B.walk_forward(_ride_folds(spark, sf), ML.WAIT_FEATURES, "wait_time_min", T.cv_params("wait"), id_col="ride_id"), lo=0.5, hi=120.0))


@register("cv_scores_surge")
def q_cv_surge(spark, sf):
    """Walk-forward folds of the surge classifier: exact AUC, mean and std."""
    return _validated(spark, sf, "surge", lambda: B.cv_scores(
        B.walk_forward(_ride_folds(spark, sf), ML.SURGE_FEATURES, "is_high_surge", T.cv_params("surge"), id_col="ride_id"), classify=True))


@register("cv_scores_demand")
def q_cv_demand(spark, sf):
    """Walk-forward folds of every city's demand model, all cities and folds grown together."""
    return _validated(spark, sf, "demand", lambda: B.cv_scores(
        B.walk_forward(_demand_folds(spark, sf), G.DEMAND_FEATURES, "rides", T.cv_params("demand"), group="city", id_col="date"), lo=0.0))


def _cv_sql(rows: str, key: str, label: str) -> str:
    """Walk-forward scores of the mean predictor over rows (scope, segment, y)."""
    return f"""
select scope, fold, round_even(avg(abs(y - pred)), 3) as mae, round_even(sqrt(avg((y - pred) * (y - pred))), 3) as rmse,
       round_even(1 - sum((y - pred) * (y - pred)) / nullif(var_pop(y) * count(y), 0), 4) as r2,
       round_even(avg(case when y > 0 then abs((y - pred) / y) end) * 100, 2) as mape, count(*) as n,
       round_even(avg(avg(abs(y - pred))) over (partition by scope), 4) as mean_mae,
       round_even(stddev_pop(avg(abs(y - pred))) over (partition by scope), 4) as std_mae,
       round_even(avg(round_even(1 - sum((y - pred) * (y - pred)) / nullif(var_pop(y) * count(y), 0), 4)) over (partition by scope), 4) as mean_r2
from (select {key} as scope, cast({label} as double) as y, cast(segment as integer) as fold, (
        select avg(cast(b.{label} as double)) from ({rows}) b where b.{key} = a.{key} and b.segment < a.segment) as pred
      from ({rows}) a where segment > 0) group by scope, fold"""


_SEGMENT = "case when pos < n - 5 * (n // 6) then 0 else floor((pos - (n - 5 * (n // 6))) / (n // 6)) + 1 end"


@register("cv_baseline_wait", on_feat(_cv_sql(f"""select 'all' as scope_key, wait_time_min, {_SEGMENT} as segment from (
  select wait_time_min, row_number() over (order by ts, ride_id) - 1 as pos, count(*) over () as n
  from (select *, row_number() over (order by ts, ride_id) as r, count(*) over () as c from feat) where r <= floor(c * 0.8))""",
                                                 "scope_key", "wait_time_min")))
def q_cv_baseline_wait(spark, sf):
    """The folds and their scores over the mean predictor, which SQL can recompute."""
    return B.cv_scores(B.walk_forward_mean(_ride_folds(spark, sf), "wait_time_min"))


@register("cv_baseline_demand", on_feat(_cv_sql(f"""select city, rides, {_SEGMENT} as segment from (
  select city, rides, row_number() over (partition by city order by date, hour) - 1 as pos, count(*) over (partition by city) as n
  from o_split where role = 'train')""", "city", "rides"), _HOURLY_CTE))
def q_cv_baseline_demand(spark, sf):
    return B.cv_scores(B.walk_forward_mean(_demand_folds(spark, sf), "rides", "city"))


@register("predict_all_models")
def q_predict_all_models(spark, sf):
    """Score every ride scenario with the stored models."""
    _entries(spark, sf, "wait", "surge", "cancellation")
    models = [_stored(spark, sf, n) for n in ("wait_time", "surge", "cancellation")]
    r = J.predict_all(J.scenarios_from_rides(_feat(spark, sf)), *models)
    return r.select("scenario_id", "city", "hour", "wait_time_min", "surge.*", F.col("cancellation.probability")
                    .alias("cancel_probability"), F.col("cancellation.label").alias("cancel_label"),
                    "demand_pressure", "recommendations")


@register("hourly_profile_models")
def q_hourly_profile_models(spark, sf):
    """J12 with the stored models: 24 hours of every day scenario, scored in one pass."""
    _entries(spark, sf, "wait", "surge", "cancellation")
    models = [_stored(spark, sf, n) for n in ("wait_time", "surge", "cancellation")]
    return J.hourly_profile(J.scenario_keys(_feat(spark, sf)).withColumn("hour", F.lit(0)), *models)


@register("model_summary")
def q_model_summary(spark, sf):
    """Every stored model: wait, surge, cancellation, and demand by city."""
    _entries(spark, sf)
    return ML.model_summary(spark, S.model_path(spark, sf, T.PARAMETERS))


@register("model_registry")
def q_model_registry(spark, sf):
    """Every stored model with its main metric, its baseline's and the mean and std over the folds.

    Fold figures are those that the cv_scores queries have stored by now (null before).
    """
    return ML.model_registry(spark, S.model_path(spark, sf, T.PARAMETERS), _entries(spark, sf))


@register("predict_demand")
def q_predict_demand(spark, sf):
    """Rides for every request (one a ride) from its city's model, in one scan."""
    cities = _entries(spark, sf, "demand").select("name", "city").collect()                 # a row a city
    models = {r["city"]: _stored(spark, sf, r["name"]) for r in cities}
    return J.predict_demand(J.scenarios_from_rides(_feat(spark, sf)), models).select("scenario_id", "city", "hour", "predicted_rides")


# ---------------------------------------------------------------------------
# A: sinks read back
# ---------------------------------------------------------------------------

from ridewise.sources import writers as WR  # noqa: E402


@register("write_clean_csv", on_feat("select * from feat"))
def q_write_csv(spark, sf):
    """All 43 columns written as CSV and read back typed."""
    path = S.stage_path(spark, sf, "csv_sink")
    feat = _feat(spark, sf)
    WR.write_clean_csv(feat, path)
    return (spark.read.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .schema(feat.schema).csv(path))


@register("write_clean_table", on_feat("select * from feat"))
def q_write_table(spark, sf):
    """The catalog table, dropped and created anew, read back whole."""
    feat = _feat(spark, sf)
    name = S.table_name(spark, sf, "rides")
    WR.write_clean_table(feat, name)
    return RD.read_rides_clean(spark, name).select(*feat.columns)


@register("read_rides_clean_city", on_feat("""
select city, vehicle_type, count(*) as rides, round_even(avg(fare_inr), 4) as mean_fare
from feat group by city, vehicle_type"""))
def q_read_clean_city(spark, sf):
    """A3 over the stored table, every city folder."""
    S.enriched(spark, sf)                                  # make sure the stored table exists
    df = RD.read_rides_clean(spark, S.stage_path(spark, sf, "enriched"))
    return df.groupBy("city", "vehicle_type").agg(F.count(F.lit(1)).alias("rides"), _rn(F.avg("fare_inr"), 4).alias("mean_fare"))


_ISSUES = " union all ".join(
    f"select distinct 'column={c};issue=invalid_value' || coalesce(';value=' || {c}, '') as item, cast(null as varchar) as field, cast(null as double) as number "
    f"from rides where not coalesce({c} in ({', '.join(repr(v) for v in valid)}), false)"
    for c, valid in (("city", C.VALID_CITIES), ("vehicle_type", C.VALID_VEHICLE_TYPES), ("weather", C.VALID_WEATHER)))
_OUTLIERS = " union all ".join(
    f"select 'column={c};issue=outliers_before_cleaning', 'count', cast(count(*) filter (where {cond}) as double) from rides"
    for c, cond in (("fare_inr", "fare_inr < 10 or fare_inr > 5000"), ("distance_km", "distance_km < 0.5 or distance_km > 80"), ("wait_time_min", "wait_time_min > 120")))
_CODES = " union all ".join(f"select distinct 'column={c};value=' || {c} as item, 'code' as field, cast({k} as double) as number from feat"
                            for c, k in (("city", "city_code"), ("vehicle_type", "vehicle_code"), ("weather", "weather_code")))
_SEASONS = ", ".join(f"('column=season;value={k}', 'code', {v}.0::double)" for k, v in C.SEASON_CODES.items())
_COLUMNS = ", ".join(f"('{c}', 'position', {i}.0::double)" for i, c in enumerate(CL.RAW_COLUMNS + D.FEATURE_ORDER))
_CLEANING = ", ".join(f"cast({c} as double) as {c}" for c in CL.REPORT_COLUMNS)

#: Every section of the report but the time stamp, as rows (section, item, field, number).
_REPORT_SQL = on_feat(f"""
select 'final_shape' as section, '' as item, 'rows' as field, cast(count(*) as double) as number from feat
union all select 'final_shape', '', 'columns', {len(CL.RAW_COLUMNS + D.FEATURE_ORDER)}
union all select 'date_range', 'end=' || max(cast(ts as date)) || ';start=' || min(cast(ts as date)), null, null from feat
union all select 'final_columns', * from (values {_COLUMNS})
union all select 'final_stats', 'column=' || "column", field, number from (unpivot ({_STAT_UNION}) on mean, median, std, min, max into name field value number)
union all select 'feature_distributions', 'feature=' || feature || ';value=' || value, 'count', cast(count as double) from ({_DIST_UNION})
union all select 'flag_rates', 'flag=' || flag, 'rate', rate from ({_FLAG_UNION})
union all select 'validation', * from ({_ISSUES})
union all select 'validation', 'column=' || "column" || ';issue=nulls_before_cleaning', 'count', cast(null_count as double) from ({_NULL_UNION}) where null_count > 0
union all select 'validation', * from ({_OUTLIERS})
union all select 'validation', 'issue=duplicates_before_cleaning', 'count', cast(coalesce(sum(c - 1), 0) as double)
  from (select count(*) as c from rides group by city, ts, vehicle_type, distance_km)
union all select 'cleaning', '', field, number from (unpivot (select {_CLEANING} from ({_CLEANING_SELECT})) on columns(*) into name field value number)
union all select 'encodings', * from ({_CODES})
union all select 'encodings', * from (values {_SEASONS})""")


@register("quality_report_rows", _REPORT_SQL)
def q_quality_report_rows(spark, sf):
    """E6 read back: all sections of the report."""
    return R.report_rows(q_quality_report(spark, sf))


@register("write_quality_report", _REPORT_SQL)
def q_write_report(spark, sf):
    """The whole batch ETL, and the report file it wrote read back."""
    from ridewise.plans.etl import run_on
    out = S.stage_path(spark, sf, "etl_run")
    res = run_on(S.raw(spark, sf), out, zones=C.fixture_zones(), write_csv=False)
    return R.report_rows(spark.read.text(res["report"]), "value")


# ---------------------------------------------------------------------------
# Structured Streaming: the counter and the scorer over file streams of the
# stored ride tables, drained with an availableNow trigger.
# ---------------------------------------------------------------------------

from ridewise.streaming import live as LV  # noqa: E402


@register("stream_hourly_volume", on_raw("""
select city, date_trunc('hour', ts) as hour_start, count(*) as rides from rides
where city in ('Delhi NCR','Mumbai','Bengaluru','Chennai','Hyderabad') group by 1, 2"""))
def q_stream_volume(spark, sf):
    S.raw(spark, sf)
    stream = LV.read_ride_stream(spark, S.stage_path(spark, sf, "raw"))
    return LV.drain_volume(LV.valid_rides(stream), S.stage_path(spark, sf, "stream_volume"))


@register("stream_rule_scoring", on_feat(f"""
select ride_id as scenario_id, rule_wait, rule_surge_prob, demand_pressure from (
  select *, {_RULE_SQL},
         round_even(cast(surge_multiplier as double) + case when hour in (7,8,9,17,18,19,20) then 0.5::double else 0.0::double end
           + case when weather in ('light_rain', 'heavy_rain') then 0.4::double else 0.0::double end
           + case when is_festival then 0.6::double else 0.0::double end
           + case when is_ipl_day then 0.5::double else 0.0::double end, 2) as demand_pressure from feat)"""))
def q_stream_scoring(spark, sf):
    S.enriched(spark, sf)
    schema = J.scenarios_from_rides(_feat(spark, sf)).schema
    req = (spark.readStream.schema(_feat(spark, sf).schema).parquet(S.stage_path(spark, sf, "enriched"))
           .transform(J.scenarios_from_rides))
    assert req.schema == schema
    out = LV.drain_rows(LV.score_stream(req), S.stage_path(spark, sf, "stream_scores"))
    return out.select("scenario_id", "rule_wait", "rule_surge_prob", "demand_pressure")


# ---------------------------------------------------------------------------
# Remaining single-step operators of the inventory
# ---------------------------------------------------------------------------

@register("filter_valid_categories", on_clean("""
select city, vehicle_type, weather, count(*) as rides from o_valid group by all"""))
def q_filter_valid(spark, sf):
    v = CL.filter_valid_categories(S.deduped(spark, sf))
    return v.groupBy("city", "vehicle_type", "weather").agg(F.count(F.lit(1)).alias("rides"))


@register("impute_zone_rows", on_clean("""
select c.ride_id, c.pickup_zone from clean c join o_valid v on c.ride_id = v.ride_id and c.ts = v.ts
  and c.city = v.city and c.vehicle_type = v.vehicle_type and c.distance_km = v.distance_km
where v.pickup_zone is null"""))
def q_impute_zone(spark, sf):
    v = CL.filter_valid_categories(S.deduped(spark, sf)).where(F.col("pickup_zone").isNull())
    return CL.impute_zone(v.select("ride_id", "city", "pickup_zone"), C.fixture_zones()).select("ride_id", "pickup_zone")


@register("impute_wait_medians", on_clean("""
select city, vehicle_type, quantile_cont(wait_time_min, 0.5) as wait_median from o_valid group by all"""))
def q_wait_medians(spark, sf):
    v = CL.filter_valid_categories(S.deduped(spark, sf))
    return v.groupBy("city", "vehicle_type").agg(F.median("wait_time_min").alias("wait_median"))


@register("city_volume_p75", on_feat("""
select city, quantile_cont(hourly_ride_volume, 0.75) as city_volume_p75 from feat group by city"""))
def q_city_p75(spark, sf):
    return D.city_volume_p75(D.hourly_volume_table(S.clean(spark, sf).withColumns(D.time_features())))


@register("read_rides_raw_csv", on_raw("select * from rides"))
def q_read_raw_csv(spark, sf):
    """A1/A2: the raw table written as the reference's CSV (header, `timestamp` column) and read back typed."""
    path = S.stage_path(spark, sf, "raw_csv")
    (S.raw(spark, sf).withColumnRenamed("ts", "timestamp").write.mode("overwrite").option("header", True)
       .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    return RD.read_rides_raw(spark, path, "csv")


@register("cache_table", on_feat("select city, count(*) as rides from feat group by city"))
def q_cache_table(spark, sf):
    t = RD.cache_table(_feat(spark, sf).select("city", "ride_id"))
    return t.groupBy("city").agg(F.count(F.lit(1)).alias("rides"))
