"""Order statistics, AUC, histograms and correlations on inputs the oracle tables do not hold."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ridewise.operators import eda as E
from ridewise.operators import metrics as M
from ridewise.operators import timeseries as G
from ridewise.streaming import live as LV


def test_split_with_one_repeated_ride_id(spark):
    rows = [(dt.datetime(2024, 1, 1), "R1")] * 5
    got = G.temporal_split(spark.createDataFrame(rows, "ts timestamp_ntz, ride_id string"))
    assert {r.role for r in got.collect()} == {"test"}


def test_split_of_one_crowded_minute_with_microseconds(spark):
    draw = random.Random(2)
    base = dt.datetime(2024, 1, 1, 8, 30)
    rows = [(base + dt.timedelta(microseconds=draw.randrange(3_000_000)), f"R{i:05d}") for i in range(500)]
    rows += [(base, f"R{i}") for i in range(500)] + [(base + dt.timedelta(days=2), "R1")] * 20
    got = G.temporal_split(spark.createDataFrame(rows, "ts timestamp_ntz, ride_id string"), 0.7).collect()
    order = sorted(rows)
    key = order[int(len(order) * 0.7)]
    assert all((r.role == "train") == ((r.ts, r.ride_id) < key) for r in got)


def test_folds_match_ranks(spark):
    draw = random.Random(3)
    rows = [(dt.datetime(2024, 1, 1 + draw.randrange(3), 9, 0, draw.randrange(2)), f"X{i}") for i in range(300)]
    got = G.time_series_folds(spark.createDataFrame(rows, "ts timestamp_ntz, ride_id string"), 5).collect()
    rank = {r: i for i, r in enumerate(sorted(rows))}
    assert all(r.segment == max(0, (rank[r.ts, r.ride_id] - 50) // 50 + 1) for r in got)


def test_auc_of_crowded_scores(spark):
    draw = np.random.default_rng(4)
    score = np.where(draw.random(4000) < 0.9, 0.12 + draw.random(4000) / 1000, draw.random(4000) * 3 - 1).round(6)
    label = (draw.random(4000) < 0.2 + 0.3 * (score > 0.1205)).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"label": label, "score": score}))
    pos, neg = score[label == 1], score[label == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert abs(M.auc(df).first()[0] - want) < 1e-12


@pytest.mark.parametrize("values", [[0.3] * 7, [0.0, 1.0, 2.0, 2.0]])
def test_histogram_bins_are_numpys(spark, values):
    df = spark.createDataFrame([(1, v) for v in values], "label int, score double")
    counts, edges = np.histogram(values, bins=40)
    for got in (M.equal_width_histogram(df, F.col("score"), 40), M.score_histogram_by_class(df), E.surge_histogram(df, 40, "score").withColumnRenamed("rides", "count")):
        rows = sorted(got.collect(), key=lambda r: r.bin)
        assert [r["count"] for r in rows] == counts.tolist()
        assert np.allclose([r.bin_lo for r in rows], edges[:-1], atol=1e-6)


def test_correlation_is_pairwise_complete(spark):
    draw = np.random.default_rng(5)
    x = pd.DataFrame(draw.normal(size=(400, 3)) + [1e6, 0, 5], columns=["a", "b", "c"])
    x["b"] += x["a"] - 1e6
    x.loc[draw.random(400) < 0.5, "c"] = None
    x["d"] = 1.0
    got = {(r.col_a, r.col_b): r.r for r in E._corr_pairs(spark.createDataFrame(x.astype(object).where(x.notna(), None), "a double, b double, c double, d double"), list("abcd")).collect()}
    want = x.corr()
    assert len(got) == 12
    for (a, b), r in got.items():
        assert (r is None and "d" in (a, b)) or abs(r - want.loc[a, b]) < 1e-6


def test_late_files_are_counted_and_a_restart_goes_on(spark, tmp_path):
    def put(name, hours):
        rows = [(f"{name}{i}", dt.datetime(2024, 1, 1, h, 5), "Mumbai") for i, h in enumerate(hours)]
        spark.createDataFrame(rows, "ride_id string, ts timestamp_ntz, city string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def counts():
        stream = spark.readStream.schema("ride_id string, ts timestamp_ntz, city string").parquet(str(tmp_path / "in"))
        return {r.hour_start.hour: r.rides for r in LV.drain_volume(LV.valid_rides(stream), str(tmp_path / "out")).collect()}

    put("a", [20, 20, 21])
    assert counts() == {20: 2, 21: 1}
    assert counts() == {20: 2, 21: 1}
    put("b", [3, 20])                       # seventeen hours late
    assert counts() == {3: 1, 20: 3, 21: 1}
