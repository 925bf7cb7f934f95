"""Grown trees against MLlib's own fit, and what MLlib itself still fits."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from ridewise.operators import boosting as B
from ridewise.operators import growth as GR
from ridewise.operators import models as ML


def table(spark, n=3000):
    rng = np.random.default_rng(5)
    x = np.c_[rng.integers(0, 24, n), rng.integers(0, 5, n), rng.integers(0, 9, n)].astype(float)
    y = 3 + x[:, 0] * 0.3 + np.where(x[:, 1] > 2, 4, 0) * (x[:, 2] > 5) + rng.normal(size=n)
    rows = [(*map(float, v), float(t), int(t > 7), float(1 + i % 3)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, big int, w double")


@pytest.mark.parametrize("kind", ["squared", "logistic", "weighted"])
def test_grown_trees_are_mllibs(spark, kind, monkeypatch, tmp_path):
    """With every row drawn, the predictions are those of MLlib's fit, whose trees cost four times as much."""
    monkeypatch.setattr(GR, "BLOCK_ROWS", 700)
    monkeypatch.setattr(GR, "CHECKPOINT_TREES", 3)
    monkeypatch.setattr(ML, "FIT_ROWS", 1000)
    df, feats = table(spark), ["a", "b", "c"]
    own = dict(max_iter=8, max_depth=3, step=0.2, subsample=1.0, min_leaf=25)
    est = ML.gbt_regressor("y", **own) if kind == "squared" else ML.gbt_classifier("big", **own, **({"weight_col": "w"} if kind == "weighted" else {}))
    want, got = ML._pipeline(feats, est).fit(df.coalesce(1)), ML.fit(df.repartition(4), feats, est)
    column = F.col("pred") if kind == "squared" else F.col("score")
    score = ML.score_regression if kind == "squared" else ML.score_classifier

    def values(model):
        keys = [*feats, "y"]
        return np.array([r[0] for r in score(model, df).orderBy(*keys).select(column).collect()])

    assert np.allclose(values(got), values(want), atol=1e-9)
    assert (got.stages[-1].getNumTrees, got.stages[-1].getMaxIter()) == (8, 8) and got.stages[-1].treeWeights == want.stages[-1].treeWeights
    assert dict(ML.importances(got, feats)) == pytest.approx(dict(ML.importances(want, feats)), abs=1e-6)
    got.write().save(f"{tmp_path}/m")
    assert np.array_equal(values(PipelineModel.load(f"{tmp_path}/m")), values(got))


def test_mllib_fits_no_training_row(spark, monkeypatch):
    seen = []
    for cls in (GBTRegressor, GBTClassifier):
        real = cls._fit
        monkeypatch.setattr(cls, "_fit", lambda self, data, real=real: seen.append(data.count()) or real(self, data))
    df = table(spark, 400)
    a = ML.fit(df, ["a", "b"], ML.gbt_regressor("y", max_iter=3))
    again = ML.fit(df, ["a", "b"], ML.gbt_regressor("y", max_iter=3))
    assert seen == [2, 2]
    # the drawn rows are the same in every run, and no other than those of the subsample
    assert [t.toDebugString.split("\n")[1:] for t in a.stages[-1].trees] == [t.toDebugString.split("\n")[1:] for t in again.stages[-1].trees]


def test_rows_that_mllib_refuses_are_refused(spark):
    df = table(spark, 60)
    for bad, est in ((df.withColumn("a", F.expr("nullif(a, 3)")), ML.gbt_regressor("y", max_iter=2)),
                     (df.withColumn("y", F.expr("if(a = 3, null, y)")), ML.gbt_regressor("y", max_iter=2)),
                     (df.withColumn("big", F.lit(2)), ML.gbt_classifier("big", max_iter=2)),
                     (df.limit(0), ML.gbt_regressor("y", max_iter=2))):
        with pytest.raises(Exception):
            ML.fit(bad, ["a", "b"], est)


def test_cuts_are_values_or_quantiles_by_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("g"), (F.col("id") % 7).alias("few"),
                                  F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") % 3).alias("mixed"), F.lit(None).cast("double").alias("none"))
    cuts, n = B.bin_edges(df, ["few", "mixed", "none"], "g")
    assert n == 5000 and cuts["even"][0] == cuts["odd"][0] == [0, 1, 2, 3, 4, 5]
    assert cuts["odd"][1] == [0, 1] and cuts["even"][2] == []
    share = np.searchsorted(cuts["even"][1], np.arange(0, 5000, 2)) / 31
    assert len(cuts["even"][1]) == B.BINS - 1 and 0.02 < np.bincount(np.round(share * 31).astype(int)).min() / 2500 < 0.04


def test_features_of_few_bins_are_counted_together():
    """A task counts joint values of a few columns, not every feature by itself, and the sums by feature are the same."""
    rng, bins = np.random.default_rng(3), [24, 7, 12, 4, 2, 2, 2, 1, 11, 32, 32, 5, 5, 4]
    columns = GR.Columns.of([list(range(b - 1)) for b in bins])
    assert len(columns.sizes) <= 5 and max(columns.sizes) <= GR.JOINT
    x = [rng.integers(0, b, 900) for b in bins]
    joint, rows, node, r = columns.joint(x), rng.permutation(900)[:600], rng.integers(0, 3, 600), rng.normal(size=600)
    sums = [np.stack([np.bincount(joint[c][rows] + node * size, v, 3 * size).reshape(3, size) for v in (None, r)]) for c, size in enumerate(columns.sizes)]
    got = columns.apart(sums)
    for f, own in enumerate(x):
        for kind, v in enumerate((None, r)):
            want = np.bincount(own[rows] + node * B.BINS, v, 3 * B.BINS).reshape(3, B.BINS)
            assert np.allclose(got[kind, :, f], want, atol=1e-9)
        assert np.array_equal(columns.right(joint, rows, f, 1), own[rows] > 1)


def test_models_of_groups_grow_in_one_job_a_level(spark, monkeypatch):
    """groups' models cost the jobs of one, and each is the one that its own fit gives."""
    calls, real = [], GR._sums
    monkeypatch.setattr(GR, "_sums", lambda *a, **k: calls.append(1) or real(*a, **k))
    df = table(spark, 1500).withColumn("g", F.when(F.col("b") < 2, "x").when(F.col("c") > 4, "y").otherwise("z")).coalesce(1)
    est = ML.gbt_regressor("y", max_iter=4, max_depth=3, min_leaf=5)
    got = ML.fit_groups(df, "g", ["y", "z", "x"], ["a", "b", "c"], est)
    assert list(got) == ["y", "z", "x"] and len(calls) <= 4 * 3
    for g, model in got.items():
        own = ML.fit(df.where(F.col("g") == g), ["a", "b", "c"], est)
        assert [t.toDebugString.split("\n")[1:] for t in model.stages[-1].trees] == [t.toDebugString.split("\n")[1:] for t in own.stages[-1].trees]
    with pytest.raises(ValueError, match="no training rows"):
        ML.fit_groups(df, "g", ["x", "none"], ["a"], est)
