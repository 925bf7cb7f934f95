"""Sources (A1–A4, A10): typed scans of raw and processed ride tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewise.sources.schema import RIDE_SCHEMA, SOURCE_TIME_COLUMN


def _csv_schema() -> T.StructType:
    fields = [T.StructField(SOURCE_TIME_COLUMN if f.name == "ts" else f.name, f.dataType, True)
              for f in RIDE_SCHEMA.fields]
    return T.StructType(fields)


def read_rides_raw(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A1, A2: typed scan of raw rides — CSV with header (the reference's format) or Parquet.

    The schema is declared, never inferred, so the scan is a single pass and
    Parquet gets column pruning and filter pushdown.
    """
    if fmt == "csv":
        df = (spark.read.schema(_csv_schema()).option("header", True)
                   .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
        return df.withColumnRenamed(SOURCE_TIME_COLUMN, "ts")
    df = spark.read.parquet(path)
    if SOURCE_TIME_COLUMN in df.columns and "ts" not in df.columns:
        df = df.withColumnRenamed(SOURCE_TIME_COLUMN, "ts")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in RIDE_SCHEMA.fields])


def read_rides_clean(spark: SparkSession, path_or_table: str) -> DataFrame:
    """A3: processed rides from a Parquet folder or a catalog table.

    Partitioned by city on write, so a city filter prunes directories.
    """
    if "/" in path_or_table or path_or_table.startswith("file:"):
        return spark.read.parquet(path_or_table)
    return spark.table(path_or_table)


def load_summary(df: DataFrame) -> DataFrame:
    """A4: rows, columns, first and last date in one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.lit(len(df.columns)).alias("columns"),
                  F.min(F.to_date("ts")).alias("first_date"),
                  F.max(F.to_date("ts")).alias("last_date"))


def cache_table(df: DataFrame) -> DataFrame:
    """A10: keep a table between interactive queries (spills to disk when large)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
