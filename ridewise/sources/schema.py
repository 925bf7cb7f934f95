"""Explicit schemas of the ride tables (no inference on read)."""

from pyspark.sql import types as T

RIDE_SCHEMA = T.StructType([
    T.StructField("ride_id", T.StringType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("city", T.StringType(), True),
    T.StructField("pickup_zone", T.StringType(), True),
    T.StructField("vehicle_type", T.StringType(), True),
    T.StructField("wait_time_min", T.DoubleType(), True),
    T.StructField("surge_multiplier", T.DoubleType(), True),
    T.StructField("distance_km", T.DoubleType(), True),
    T.StructField("fare_inr", T.DoubleType(), True),
    T.StructField("driver_rating", T.DoubleType(), True),
    T.StructField("is_completed", T.BooleanType(), True),
    T.StructField("weather", T.StringType(), True),
    T.StructField("is_festival", T.BooleanType(), True),
    T.StructField("is_ipl_day", T.BooleanType(), True),
])

# The reference names the time column `timestamp`; the build uses `ts`.
SOURCE_TIME_COLUMN = "timestamp"
