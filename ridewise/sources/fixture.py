"""The `rides` table derived from the driver's TPC-H-style tables.

The reference application reads a generated ride CSV that is not shipped.
Its 14-column schema is rebuilt here, deterministically, from lineitem,
orders, customer and nation, so every job works on data whose volume grows
with the given tables. The same text serves Spark and the DuckDB oracle;
only the timestamp arithmetic differs between the two dialects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The derivation of the test ride table (one text, two dialects).
_TS_SPARK = ("timestampadd(MINUTE, cast(hr*60 + sd%60 as int), timestampadd(DAY, "
             "cast(datediff(l_shipdate, date'1995-01-01')%547 as int), "
             "timestamp_ntz'2023-01-01 00:00:00'))")
_TS_DUCKDB = ("timestamp '2023-01-01 00:00:00' + to_days(cast(date_diff('day', date '1995-01-01', "
              "cast(l_shipdate as date))%547 as int)) + to_minutes(cast(hr*60 + sd%60 as int))")

_RIDES_CTE = """
b0 as (
  select l.*, n.n_regionkey as rk, substr(o.o_orderpriority,1,1) as op,
         cast(l_orderkey as bigint)*7919 + cast(l_partkey as bigint)*104729
         + cast(l_suppkey as bigint)*1299709 + cast(l_linenumber as bigint)*15485863
         + cast(l_quantity as bigint)*32452843 as sd
  from @LINEITEM@ l join @ORDERS@ o on l.l_orderkey = o.o_orderkey
  join @CUSTOMER@ c on o.o_custkey = c.c_custkey
  join @NATION@ n on c.c_nationkey = n.n_nationkey),
b1 as (select *, case when sd%5<3 then case sd%7 when 0 then 7 when 1 then 8 when 2 then 9 when 3 then 17 when 4 then 18 when 5 then 19 else 20 end else sd%24 end as hr from b0),
b2 as (
  select concat('RD', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey, '-', cast(l_quantity as int)) as ride_id,
         @TS@ as ts,
         case when sd%1501=3 then 'Pune' else case rk when 0 then 'Bengaluru' when 1 then 'Chennai'
              when 2 then 'Delhi NCR' when 3 then 'Hyderabad' else 'Mumbai' end end as city,
         case op when '1' then 'premium' when '2' then 'auto' when '3' then 'bike_taxi'
              when '4' then 'economy' else 'shared' end as vehicle_type,
         cast(case when sd%50=7 then null when sd%997=5 then 150.0 else 1.0 + (sd%240)/10.0 end as double) as wait_time_min,
         cast(1.0 + 0.25*cast(round(l_discount*100) as int) as double) as surge_multiplier,
         cast(0.5 + 0.25*l_quantity as double) as distance_km,
         cast(case sd%200 when 1 then 0.0 when 2 then 9999.0 when 3 then -1.0
              else round(l_extendedprice/200, 1) end as double) as fare_inr,
         cast(case when sd%100=9 then null else 3.0 + 0.5*(sd%5) end as double) as driver_rating,
         sd%16 <> 0 as is_completed,
         case when sd%1777=4 then null else case concat(l_returnflag, l_linestatus) when 'NF' then 'fog'
              when 'RF' then 'light_rain' when 'RO' then 'heavy_rain' else 'clear' end end as weather,
         sd
  from b1),
b3 as (select *, case when sd%200=11 then null else concat(city, ' Z', sd%15) end as pickup_zone,
              cast(cast(ts as date) as string) as d from b2),
b4 as (select ride_id, ts, city, pickup_zone, vehicle_type, wait_time_min, surge_multiplier, distance_km,
              fare_inr, driver_rating, is_completed, weather,
              d in ('2023-01-26','2023-03-08','2023-04-04','2023-04-14','2023-08-15','2023-09-19','2023-10-02','2023-10-24','2023-11-12','2023-11-13','2023-11-27','2023-12-25','2023-12-31','2024-01-01','2024-01-22','2024-01-26','2024-03-25','2024-04-11','2024-05-23','2024-06-17') as is_festival,
              ((city='Delhi NCR' and d in ('2023-04-01','2023-04-08','2023-04-15','2023-04-22','2023-04-29','2023-05-06','2023-05-13','2024-03-24','2024-04-06','2024-04-14','2024-04-21','2024-04-28','2024-05-05','2024-05-12')) or (city='Mumbai' and d in ('2023-04-02','2023-04-09','2023-04-16','2023-04-23','2023-04-30','2023-05-07','2023-05-14','2024-03-23','2024-03-30','2024-04-07','2024-04-13','2024-04-20','2024-04-27','2024-05-04')) or (city='Bengaluru' and d in ('2023-04-03','2023-04-10','2023-04-17','2023-04-24','2023-05-01','2023-05-08','2024-03-22','2024-03-29','2024-04-08','2024-04-15','2024-04-22','2024-04-29','2024-05-06')) or (city='Chennai' and d in ('2023-04-04','2023-04-11','2023-04-18','2023-04-25','2023-05-02','2023-05-09','2023-05-16','2024-03-25','2024-04-01','2024-04-09','2024-04-16','2024-04-23','2024-04-30','2024-05-07')) or (city='Hyderabad' and d in ('2023-04-05','2023-04-12','2023-04-19','2023-04-26','2023-05-03','2023-05-10','2024-03-26','2024-04-02','2024-04-10','2024-04-17','2024-04-24','2024-05-01','2024-05-08'))) as is_ipl_day, sd from b3),
rides as (
  select ride_id, ts, city, pickup_zone, vehicle_type, wait_time_min, surge_multiplier, distance_km, fare_inr,
         driver_rating, is_completed, weather, is_festival, is_ipl_day from b4
  union all
  select ride_id, ts, city, pickup_zone, vehicle_type, wait_time_min, surge_multiplier, distance_km, fare_inr,
         driver_rating, is_completed, weather, is_festival, is_ipl_day from b4 where sd%333=0)
"""

_SOURCE_TABLES = ("lineitem", "orders", "customer", "nation")

# Spark form of the last CTE: the same rows as ``b4 UNION ALL (b4 WHERE sd%333=0)``,
# produced in one pass by emitting a second copy of the selected rows instead of
# evaluating the join chain twice.
_RIDES_ONE_PASS = """rides as (
  select ride_id, ts, city, pickup_zone, vehicle_type, wait_time_min, surge_multiplier, distance_km, fare_inr,
         driver_rating, is_completed, weather, is_festival, is_ipl_day
  from b4 lateral view explode(if(sd%333=0, array(1, 2), array(1))) copies as copy_no)
"""


def rides_cte(dialect: str = "duckdb") -> str:
    """The `rides` CTE body (without the leading ``with``) for one dialect."""
    ts = _TS_SPARK if dialect == "spark" else _TS_DUCKDB
    text = _RIDES_CTE.replace("@TS@", ts)
    if dialect == "spark":
        text = text[:text.index("rides as (")] + _RIDES_ONE_PASS
    for t in _SOURCE_TABLES:
        text = text.replace(f"@{t.upper()}@", t if dialect != "spark" else "{" + t + "}")
    return text


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan that arrives in fewer splits than the cluster has cores.

    A large table arrives in thousands of splits and is returned untouched;
    a file with a single row group is read by one task, so it is spread by a
    round-robin repartition before the per-row work starts.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def rides_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ride records (14 columns) derived from the driver's tables.

    lineitem ⋈ orders is the one large equi-join (shuffled on the order key);
    customer and nation are dimension-sized and joined by hash or broadcast as
    Catalyst and AQE decide from the scanned sizes.
    """
    tables = {t: load_table(spark, sf_dir, t) for t in _SOURCE_TABLES}
    tables["lineitem"] = ensure_parallelism(tables["lineitem"])
    return spark.sql("with " + rides_cte("spark") + " select * from rides", **tables)
