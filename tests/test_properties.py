"""Invariants of the stages on the smallest driver tables."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from ridewise.operators import clean as CL
from ridewise.operators import timeseries as G
from ridewise.plans import stages as S

SMALL = "/root/testdata/sf0.001"
NUMERIC = ["wait_time_min", "surge_multiplier", "distance_km", "fare_inr", "driver_rating"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["city", "rides", "median_wait", "median_fare",
                                                  "mean_surge", "completion_rate"]


def test_clean_has_no_nulls_and_ranges(spark):
    c = S.clean(spark, SMALL)
    assert c.agg(F.sum(CL.null_cells(c))).first()[0] == 0
    r = c.agg(F.min("fare_inr"), F.max("fare_inr"), F.min("wait_time_min"), F.max("wait_time_min")).first()
    assert 10 <= r[0] and r[1] <= 5000 and 0.5 <= r[2] and r[3] <= 120


def test_clean_is_idempotent(spark):
    c = S.clean(spark, SMALL)
    from ridewise import config as C
    again = CL.clean_rides(c, zones=C.fixture_zones())
    assert again.count() == c.count()
    assert again.exceptAll(c).count() == 0


def test_volumes_sum_to_rows(spark):
    e = S.enriched(spark, SMALL)
    per = e.groupBy("city", "date", "hour").agg(F.max("hourly_ride_volume").alias("v"), F.count(F.lit(1)).alias("n"))
    assert per.where(F.col("v") != F.col("n")).count() == 0


def test_lag_drop_count(spark):
    h = G.hourly_dataset(S.enriched(spark, SMALL))
    kept = G.lag_features(h).groupBy("city", "hour").count()
    total = h.groupBy("city", "hour").agg(F.count(F.lit(1)).alias("n"))
    j = total.join(kept, ["city", "hour"], "left").fillna(0, ["count"])
    assert j.where(F.col("count") != F.greatest(F.col("n") - 7, F.lit(0))).count() == 0


def test_ride_split_is_a_prefix(spark):
    e = S.enriched(spark, SMALL).select("ride_id", "ts")
    s = G.temporal_split(e)
    n = e.count()
    assert s.where(F.col("role") == "train").count() == int(n * 0.8)
    last_train = s.where(F.col("role") == "train").agg(F.max(F.struct("ts", "ride_id"))).first()[0]
    first_test = s.where(F.col("role") == "test").agg(F.min(F.struct("ts", "ride_id"))).first()[0]
    assert tuple(last_train) < tuple(first_test)


def test_ride_folds_disjoint_and_ordered(spark):
    e = S.enriched(spark, SMALL).select("ride_id", "ts")
    f = G.time_series_folds(e)
    seg = f.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ts", "ride_id")).alias("lo"),
                                   F.max(F.struct("ts", "ride_id")).alias("hi")).orderBy("segment").collect()
    n = e.count()
    assert [r.segment for r in seg] == [0, 1, 2, 3, 4, 5]
    assert all(r.n == n // 6 for r in seg[1:])
    for a, b in zip(seg, seg[1:]):
        assert tuple(a.hi) < tuple(b.lo)
