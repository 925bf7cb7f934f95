"""The batch ETL: load → validate → clean → engineer → encode → store → report.

``run_pipeline`` is one lazy plan per stage with actions only at the
writes: the validation issues and the cleaning counters are aggregates, the
processed table is written partitioned by city, the report is one JSON row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ridewise.operators import clean as CL
from ridewise.operators import features as D
from ridewise.operators import quality as Q
from ridewise.operators import reports as R
from ridewise.sources import readers as RD
from ridewise.sources import writers as W


def run_pipeline(spark: SparkSession, raw_path: str, out_dir: str, fmt: str = "csv",
                 zones: Mapping[str, Sequence[str]] | None = None, write_csv: bool = True) -> dict:
    """Run every stage and return the paths written and the final row count."""
    raw = RD.read_rides_raw(spark, raw_path, fmt)
    return run_on(raw, out_dir, zones, write_csv)


def run_on(raw: DataFrame, out_dir: str, zones: Mapping[str, Sequence[str]] | None = None,
           write_csv: bool = True) -> dict:
    spark = raw.sparkSession
    out = out_dir.rstrip("/")
    validation = Q.validation_issues(raw)
    clean, cleaning = CL.clean_with_report(raw, zones=zones)
    table = f"{out}/rides"
    rows = W.write_clean_table(D.enrich(clean), table)
    enriched = spark.read.parquet(table).select(*CL.RAW_COLUMNS, *D.FEATURE_ORDER)      # cut lineage: start from the stored table
    if write_csv:
        W.write_clean_csv(enriched, f"{out}/rides_csv")
    report = R.quality_report(enriched, validation=validation, cleaning=cleaning,
                              encodings=D.encoding_maps(enriched))
    W.write_quality_report(report, f"{out}/quality_report")
    return {"table": table, "csv": f"{out}/rides_csv" if write_csv else None,
            "report": f"{out}/quality_report", "rows": rows}
