"""Sinks (A5–A7): processed rides as CSV and as a city-partitioned table, and
the JSON quality report. Writes are distributed (one file per task and city
partition); nothing is gathered to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewise.functions.lineage import bounded_tasks


def write_clean_csv(df: DataFrame, path: str) -> None:
    """A5: CSV with header; the calendar date written as text (yyyy-MM-dd)."""
    out = df.withColumn("date", F.col("date").cast("string")) if "date" in df.columns else df
    (out.write.mode("overwrite").option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def write_clean_table(df: DataFrame, target: str, partition_by: str = "city") -> int:
    """Replace the processed table and return its row count.

    ``target`` is a folder (Parquet, partitioned by city so per-city reads
    prune directories) or the name of a catalog table, which is dropped and
    created in the session catalog's warehouse.
    """
    spark = df.sparkSession
    if "/" in target or target.startswith("file:"):
        with bounded_tasks(spark):
            df.write.mode("overwrite").partitionBy(partition_by).parquet(target)
        return spark.read.parquet(target).count()
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    with bounded_tasks(spark):
        df.write.partitionBy(partition_by).saveAsTable(target)
    return spark.table(target).count()


def write_quality_report(report: DataFrame, path: str) -> None:
    """The one-row JSON report (see reports.quality_report)."""
    # one row: a single output file is the natural layout for a report
    report.select("report").coalesce(1).write.mode("overwrite").text(path)
