"""DuckDB texts of the shared stages, used as CTE prefixes by the oracle SQL.

These are the *checks*, written independently of the Spark jobs: plain
window functions and scalar subqueries over the `rides` fixture.
"""

from __future__ import annotations

from ridewise.sources.fixture import rides_cte

CLEAN_CTES = """
o_dedup as (
  select * exclude (o_rn) from (
    select *, row_number() over (partition by city, ts, vehicle_type, distance_km order by ride_id) as o_rn
    from rides) where o_rn = 1),
o_valid as (
  select * from o_dedup
  where city in ('Delhi NCR','Mumbai','Bengaluru','Chennai','Hyderabad')
    and vehicle_type in ('bike_taxi','auto','economy','premium','shared')
    and weather in ('clear','light_rain','heavy_rain','fog')),
o_w1 as (
  select v.* replace (coalesce(v.wait_time_min, m.med) as wait_time_min)
  from o_valid v left join (
    select city, vehicle_type, quantile_cont(wait_time_min, 0.5) as med
    from o_valid group by city, vehicle_type) m
  on v.city = m.city and v.vehicle_type = m.vehicle_type),
o_w2 as (
  select * replace (coalesce(wait_time_min, (select quantile_cont(wait_time_min, 0.5) from o_w1)) as wait_time_min)
  from o_w1),
o_r1 as (
  select v.* replace (coalesce(v.driver_rating, m.med) as driver_rating)
  from o_w2 v left join (
    select city, quantile_cont(driver_rating, 0.5) as med from o_w2 group by city) m
  on v.city = m.city),
o_z1 as (
  select * replace (coalesce(pickup_zone,
      city || ' Z' || cast(cast('0x' || substr(md5(ride_id), 1, 8) as bigint) % 15 as varchar)) as pickup_zone)
  from o_r1),
clean as (
  select * replace (
    case when fare_inr is null then null else greatest(least(fare_inr, 5000.0::double), 10.0::double) end as fare_inr,
    case when distance_km is null then null else greatest(least(distance_km, 80.0::double), 0.5::double) end as distance_km,
    case when wait_time_min is null then null else greatest(least(wait_time_min, 120.0::double), 0.5::double) end as wait_time_min,
    case when surge_multiplier is null then null else greatest(least(surge_multiplier, 4.0::double), 1.0::double) end as surge_multiplier,
    case when driver_rating is null then null else greatest(least(driver_rating, 5.0::double), 1.0::double) end as driver_rating)
  from o_z1)
"""

FEAT_CTES = """
o_f0 as (
  select *, cast(hour(ts) as integer) as hour, cast(isodow(ts) - 1 as integer) as day_of_week,
         dayname(ts) as day_name, cast(month(ts) as integer) as month, monthname(ts) as month_name,
         cast(weekofyear(ts) as integer) as week_of_year, cast(quarter(ts) as integer) as quarter,
         cast(ts as date) as date
  from clean),
o_f1 as (
  select *,
    cast(hour in (7,8,9,17,18,19,20) as integer) as is_peak_hour,
    cast(day_of_week >= 5 as integer) as is_weekend,
    cast(hour in (22,23,0,1,2,3,4) as integer) as is_night,
    cast(hour in (0,1,2,3,4) as integer) as is_late_night,
    case when month in (12,1,2) then 'winter' when month in (3,4,5) then 'summer'
         when month in (6,7,8,9) then 'monsoon' else 'post_monsoon' end as season,
    cast(weather in ('light_rain','heavy_rain') as integer) as is_raining,
    cast(weather = 'heavy_rain' as integer) as is_heavy_rain,
    cast(weather = 'fog' as integer) as is_fog
  from o_f0),
o_f2 as (
  select *,
    round_even(fare_inr / distance_km, 2) as fare_per_km,
    round_even(surge_multiplier + is_peak_hour * 0.5::double + is_raining * 0.4::double
               + cast(is_festival as integer) * 0.6::double + cast(is_ipl_day as integer) * 0.5::double, 3) as demand_pressure,
    cast(surge_multiplier >= 2.0 as integer) as is_high_surge,
    case when surge_multiplier is null or surge_multiplier <= 0 or surge_multiplier > 5 then 'nan'
         when surge_multiplier <= 1.0 then 'no_surge' when surge_multiplier <= 1.5 then 'low'
         when surge_multiplier <= 2.0 then 'medium' when surge_multiplier <= 2.5 then 'high'
         else 'extreme' end as surge_band,
    case when wait_time_min is null or wait_time_min <= 0 or wait_time_min > 120 then 'nan'
         when wait_time_min <= 3 then 'very_fast' when wait_time_min <= 6 then 'fast'
         when wait_time_min <= 10 then 'normal' when wait_time_min <= 15 then 'slow'
         else 'very_slow' end as wait_band,
    count(*) over (partition by city, date, hour) as hourly_ride_volume
  from o_f1),
o_f3 as (
  select f.*, cast(f.hourly_ride_volume >= p.p75 as integer) as is_high_demand,
    greatest(cast(f.is_festival as integer), cast(f.is_ipl_day as integer)) as is_event_day,
    cast(f.hour * 60 + minute(f.ts) as integer) as minutes_since_midnight
  from o_f2 f join (select city, quantile_cont(hourly_ride_volume, 0.75) as p75 from o_f2 group by city) p
  on f.city = p.city),
feat as (
  select *,
    cast(dense_rank() over (order by city) - 1 as integer) as city_code,
    cast(dense_rank() over (order by vehicle_type) - 1 as integer) as vehicle_code,
    cast(dense_rank() over (order by weather) - 1 as integer) as weather_code,
    cast(case season when 'winter' then 0 when 'summer' then 1 when 'monsoon' then 2
         when 'post_monsoon' then 3 end as integer) as season_code
  from o_f3)
"""


def with_rides(select_sql: str, *ctes: str) -> str:
    parts = [rides_cte("duckdb")] + [c.strip() for c in ctes if c]
    return "with " + ",\n".join(p.strip().rstrip(",") for p in parts) + "\n" + select_sql


def on_raw(select_sql: str, extra: str = "") -> str:
    return with_rides(select_sql, extra)


def on_clean(select_sql: str, extra: str = "") -> str:
    return with_rides(select_sql, CLEAN_CTES, extra)


def on_feat(select_sql: str, extra: str = "") -> str:
    return with_rides(select_sql, CLEAN_CTES, FEAT_CTES, extra)
