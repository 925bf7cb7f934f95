"""Hand-written tables for the semantic traps of the reference (bands, clips,
nulls in domain filters, row-based lags, ride-weighted quantiles, folds,
imputation fallbacks, calendars)."""

import datetime as dt

from pyspark.sql import functions as F

from ridewise import config as C
from ridewise.functions.columns import clip, not_in, round_np, surge_band, wait_band
from ridewise.operators import clean as CL
from ridewise.operators import features as D
from ridewise.operators import timeseries as G


def test_surge_band_edges(spark):
    df = spark.createDataFrame([(1.0,), (1.5,), (1.75,), (2.0,), (2.5,), (4.0,), (None,)], "s double")
    out = df.select("s", surge_band("s").alias("b"), D.is_high_surge("s").alias("hs")).collect()
    assert [r.b for r in out] == ["no_surge", "low", "medium", "medium", "high", "extreme", "nan"]
    assert [r.hs for r in out][3] == 1          # 2.0 is band 'medium' yet high surge


def test_wait_band_right_closed(spark):
    df = spark.createDataFrame([(3.0,), (3.1,), (10.0,), (120.0,), (121.0,)], "w double")
    assert [r[0] for r in df.select(wait_band("w")).collect()] == ["very_fast", "fast", "normal", "very_slow", "nan"]


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (9999.0,), (50.0,)], "x double")
    assert [r[0] for r in df.select(clip("x", 10, 5000)).collect()] == [None, 10.0, 5000.0, 50.0]


def test_domain_filter_and_invalid_set(spark):
    df = spark.createDataFrame([(None,), ("Pune",), ("Mumbai",)], "city string")
    bad = [r[0] for r in df.where(not_in("city", C.VALID_CITIES)).collect()]
    assert set(bad) == {None, "Pune"}
    kept = df.where(F.col("city").isin(C.VALID_CITIES)).collect()
    assert [r[0] for r in kept] == ["Mumbai"]


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (2.5,), (3.5,)], "x double")
    got = [r[0] for r in df.select(round_np("x", 2).alias("a")).collect()]
    assert got == [0.12, 0.14, 2.5, 3.5]
    assert [r[0] for r in df.select(round_np("x", 0)).collect()][2:] == [2.0, 4.0]


def _hourly(spark, rides, dates):
    rows = [("X", dt.date(2024, 1, d), 8, r) for d, r in zip(dates, rides)]
    return spark.createDataFrame(rows, "city string, date date, hour int, rides long")


def test_lag_and_roll(spark):
    rides = [i * i for i in range(1, 11)]
    h = _hourly(spark, rides, list(range(1, 11)))
    out = G.lag_features(h, drop_incomplete=False).orderBy("date").collect()
    assert out[0].rides_lag_1d is None and out[1].rides_lag_1d == 1
    assert out[6].rides_lag_7d is None and out[7].rides_lag_7d == 1
    roll3 = [None if r.rides_roll_3d is None else round(r.rides_roll_3d, 3) for r in out[:5]]
    assert roll3 == [None, 1.0, 2.5, 4.667, 9.667]
    kept = G.lag_features(h).count()
    assert kept == 10 - 7


def test_lag_skips_missing_days(spark):
    h = _hourly(spark, [5, 6, 7], [1, 2, 5])
    out = G.lag_features(h, drop_incomplete=False).orderBy("date").collect()
    assert out[2].rides_lag_1d == 6            # previous *observed* day, not the calendar day


def test_ride_weighted_quantile(spark):
    # volumes 1, 2, 3, 10 each carried by that many rides → quantile over rides
    vol = spark.createDataFrame([("X", 1), ("X", 2), ("X", 3), ("X", 10)], "city string, hourly_ride_volume long")
    got = D.city_volume_p75(vol).first().city_volume_p75
    expanded = [1] + [2] * 2 + [3] * 3 + [10] * 10
    import numpy as np
    assert abs(got - float(np.quantile(expanded, 0.75))) < 1e-12


def test_plain_quantile_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    r = df.agg(F.median("x").alias("m"), F.percentile("x", 0.75).alias("p")).first()
    assert (r.m, r.p) == (2.5, 4.75)


def test_folds_n12(spark):
    rows = [("X", dt.date(2024, 1, 1 + i), 0, 1) for i in range(12)]
    df = spark.createDataFrame(rows, "city string, date date, hour int, rides long")
    sizes = G.fold_sizes(G.hourly_folds(df)).orderBy("fold").collect()
    assert [r.train_size for r in sizes] == [2, 4, 6, 8, 10]
    assert [r.val_size for r in sizes] == [2, 2, 2, 2, 2]


def test_impute_fallbacks(spark):
    rows = [("a", "Mumbai", "auto", None, None), ("b", "Mumbai", "economy", 4.0, 4.0),
            ("c", "Chennai", "auto", 8.0, None)]
    df = spark.createDataFrame(rows, "ride_id string, city string, vehicle_type string, "
                                     "wait_time_min double, driver_rating double")
    w = CL.impute_wait_global_median(CL.impute_wait_group_median(df))
    got = {r.ride_id: r.wait_time_min for r in w.collect()}
    assert got["a"] == 6.0                       # group (Mumbai, auto) all null → global median of filled
    r = {x.ride_id: x.driver_rating for x in CL.impute_rating_city_median(df).collect()}
    assert r["c"] is None and r["a"] == 4.0     # city without ratings stays null


def test_calendar(spark):
    df = spark.createDataFrame([("Mumbai", dt.datetime(2023, 4, 2, 10)), ("Chennai", dt.datetime(2023, 4, 2, 10))],
                               "city string, ts timestamp_ntz")
    out = {r.city: r.is_ipl_day for r in D.calendar_enrich(df).collect()}
    assert out == {"Mumbai": True, "Chennai": False}


def test_dedup_ties_broken_by_ride_id(spark):
    t = dt.datetime(2024, 1, 1, 8)
    rows = [("r2", t, "Mumbai", "auto", 1.0), ("r1", t, "Mumbai", "auto", 1.0), ("r3", t, "Mumbai", "auto", 2.0)]
    df = spark.createDataFrame(rows, "ride_id string, ts timestamp_ntz, city string, vehicle_type string, "
                                     "distance_km double")
    assert sorted(r.ride_id for r in CL.dedup_rides(df).collect()) == ["r1", "r3"]


def test_kth_ride_id_by_prefix_narrowing(spark):
    ids = [f"RD{a}{b}-{c}" for a in range(3) for b in range(4) for c in range(5)] + ["RD1", "RD12"]
    df = spark.createDataFrame([(i,) for i in ids], "ride_id string")
    want = sorted(ids)
    for k in (0, 1, 7, 30, len(ids) - 1):
        assert G._kth_ride_id(df, k, step=1) == want[k]
        assert G._kth_ride_id(df, k) == want[k]


def test_missing_columns_are_listed(spark):
    from ridewise.operators import quality as Q
    from ridewise.operators.clean import RAW_COLUMNS

    df = spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS if c not in ("city", "ts")])
    assert sorted(r["column"] for r in Q.missing_columns(df).collect()) == ["city", "ts"]
