"""What the shared stages and the ride-level splits read, sort and write."""

import datetime as dt

from pyspark.sql import functions as F

from ridewise.functions import lineage
from ridewise.operators import clean, timeseries
from ridewise.plans import stages


def _rides(spark, n=200):
    return spark.range(n).select(
        F.format_string("R%05d", "id").alias("ride_id"), (F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(hours=F.col("id").cast("int"))).cast("timestamp_ntz").alias("ts"),
        F.concat(F.lit("c"), F.col("id") % 7).alias("city"), F.lit("auto").alias("vehicle_type"), F.lit(1.5).alias("distance_km"))


def test_stage_is_written_unsorted_by_bounded_tasks(spark, tmp_path, monkeypatch):
    """The table was sorted by city, over splits of 128 MB, to write one file a city."""
    name, seen = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(name)
    real = stages.bounded_tasks

    def watched(session):
        seen.append(session)
        return real(session)

    monkeypatch.setattr(stages, "bounded_tasks", watched)
    rows = _rides(spark)
    back = stages.materialise(rows, f"{tmp_path}/t", rows.columns)
    assert seen and spark.conf.get(name) == before
    with lineage.bounded_tasks(spark):
        assert int(spark.conf.get(name).rstrip("b")) == lineage.SPLIT_BYTES
        assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 5
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_dedup_sorts_by_time_before_texts(spark):
    twice = _rides(spark).union(_rides(spark).withColumn("ride_id", F.concat(F.lit("Z"), "ride_id")))
    plan = clean.dedup_rides(twice)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate [ts") >= 0
    assert sorted(map(tuple, clean.dedup_rides(twice).collect())) == sorted(map(tuple, _rides(spark).collect()))


def test_fold_boundaries_read_the_table_a_fixed_number_of_times(spark, monkeypatch):
    """every prefix of every boundary's ride_id was looked up in the whole table."""
    copies = []
    real = timeseries.store

    def stored(df, label):
        copies.append(df.count())
        return real(df, label)

    monkeypatch.setattr(timeseries, "store", stored)
    rows = _rides(spark, 24 * 30)
    folds = {r["segment"]: r["count"] for r in timeseries.time_series_folds(rows).groupBy("segment").count().collect()}
    assert folds == dict.fromkeys(range(6), 120)
    assert copies and copies[0] <= 5 * 24


def test_value_counts_are_those_of_the_processed_rides(spark, small_dir):
    """F16: the query counted raw rides, before cleaning."""
    from ridewise.plans.catalog import REGISTRY
    rows = REGISTRY["value_counts_share"][0](spark, small_dir).collect()
    n = stages.enriched(spark, small_dir).count()
    assert {f: sum(r["count"] for r in rows if r["feature"] == f) for f in ("city", "vehicle_type")} == {"city": n, "vehicle_type": n}
    assert n < stages.raw(spark, small_dir).count()
