"""Exact quantiles by counting, and the reports that use them."""

import contextlib
import io
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridewise.functions import quantiles as Q
from ridewise.operators import clean as CL
from ridewise.operators import eda, quality, reports
from ridewise.plans import stages as S

SMALL = "/root/testdata/sf0.001"


def formatted(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("local", [Q.LOCAL_ROWS, 0])
def test_quantiles_equal_percentile(spark, monkeypatch, local):
    """With ranges as values in the plan, and stored."""
    monkeypatch.setattr(Q, "LOCAL_ROWS", local)
    rng = np.random.default_rng(5)
    rows = [("a", float(v)) for v in rng.normal(size=5000)] + [("b", float(v)) for v in rng.integers(0, 9, 3000)] + [("c", 1.5)]
    rows += [(None, float(v)) for v in (3, 1, 2, 2)] + [("d", None), ("e", float("nan")), ("e", 4.0), ("f", 1e300), ("f", -1e300), ("f", 5e-324), ("f", 0.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.prob): r.quantile for r in Q.exact_quantiles(df, ["g"], probs).collect()}
    for g in ("a", "b", "c", None, "e", "f"):
        v = [x for k, x in rows if k == g and x is not None and x == x]
        for p in probs:
            assert got[g, p] == pytest.approx(float(np.quantile(v, p)), rel=1e-12, abs=1e-300), (g, p)
    assert ("d", 0.5) not in got and len(got) == 6 * len(probs)
    assert Q.exact_quantiles(df.limit(0), ["g"], [0.5]).count() == 0


def test_quantiles_with_weights_and_without_keys(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (9.0, 2), (7.0, 0)], "v double, w int")
    assert Q.exact_quantiles(df, [], [0.5], weight="w").first().quantile == float(np.median([1, 1, 1, 2, 9, 9]))


def test_a_million_distinct_fares_of_one_group(spark):
    """No task holds them: what crosses the exchange of a round is at most a row a bin and range."""
    df = spark.range(1_000_000).select(F.lit("x").alias("g"), (F.rand(3) * 5000).alias("v")).cache()
    got = Q.exact_quantiles(df, ["g"], [0.25, 0.5]).orderBy("prob").collect()
    want = df.agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5)))).first()[0]
    assert [r.quantile for r in got] == pytest.approx(want, rel=1e-12) and got[0].n == 1_000_000
    ranges = df.groupBy(F.floor(F.col("v") / 5000 * Q.BINS)).count()
    assert ranges.count() <= Q.BINS and ranges.agg(F.max("count")).first()[0] < 1_000_000 / Q.BINS * 2
    df.unpersist()


def test_medians_impute_and_observe(spark):
    rows = [("1", "Mumbai", "auto", w, r) for w, r in ((1.0, 3.0), (4.0, None), (None, 5.0))] + [("2", "Chennai", "auto", None, None)]
    df = spark.createDataFrame(rows, "ride_id string, city string, vehicle_type string, wait_time_min double, driver_rating double")
    got = df.transform(CL.impute_wait_group_median).transform(CL.impute_wait_global_median).transform(CL.impute_rating_city_median)
    assert sorted((r.city, r.wait_time_min, r.driver_rating) for r in got.collect()) == sorted(
        [("Mumbai", 1.0, 3.0), ("Mumbai", 4.0, 4.0), ("Mumbai", 2.5, 5.0), ("Chennai", 2.5, None)], key=lambda r: (r[0], r[1]))
    report = formatted(S.cleaning(spark, SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", report)            # counts of rows only, no second imputation
    assert schemas and not any(schemas) and "Join" not in report


def test_profile_and_summary_plans(spark):
    raw = S.raw(spark, SMALL)
    assert "Expand" not in formatted(quality.column_profile(raw))
    one = formatted(reports.raw_summary(raw))
    assert one.split("(1) Scan")[0].count("Scan parquet") == 1


def test_correlation_leaves_nan_and_null_out(spark):
    nan = float("nan")
    rows = [(1.0, 2.0, 1.0), (2.0, 4.0, nan), (3.0, 6.0, 3.0), (nan, 5.0, 4.0), (None, 1.0, 5.0), (4.0, 8.0, None)]
    got = {(r.col_a, r.col_b): r.r for r in eda.corr_raw(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    x = np.array([[np.nan if v is None else v for v in r] for r in rows])
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            if i != j:
                both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
                assert got[a, b] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-4)
