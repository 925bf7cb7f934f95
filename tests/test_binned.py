"""Looked-up paths, joint columns and dealt blocks of the tree growers."""

import numpy as np
import pytest

from ridewise.operators import binned as BN
from ridewise.operators import boosting as B
from ridewise.operators import growth as GR


def drawn_tree(rng, bins, levels):
    n = 2 ** (levels + 1) - 1
    feature, cut = np.full(n, -1), np.zeros(n, int)
    for i in range(2 ** levels - 1):
        if i == 0 or feature[(i - 1) // 2] >= 0 and rng.random() < 0.8:
            feature[i] = rng.integers(0, len(bins))
            cut[i] = rng.integers(0, bins[feature[i]])
    return feature, cut


@pytest.mark.parametrize("levels", [0, 1, 3, 5, 6])
def test_looked_up_paths_end_where_walked_ones_do(levels):
    """F2-F16: a row's end is looked up by column, at any depth, where every level walked every row down from the root."""
    rng, bins = np.random.default_rng(levels), [24, 7, 2, 2, 1, 32, 32, 5]
    columns = BN.Columns.of([range(b - 1) for b in bins])
    x = np.stack([rng.integers(0, b, 2000) for b in bins])
    for _ in range(20):
        feature, cut = drawn_tree(rng, bins, levels)
        want = np.zeros(2000, int)
        for _ in range(levels):
            f = feature[want]
            right = x[np.maximum(f, 0), np.arange(2000)] > cut[want]
            want = np.where(f >= 0, 2 * want + 1 + right, want)
        paths = BN.Paths(feature, cut, levels, columns)
        assert np.array_equal(paths.ends.take(paths.places(columns.joint(x))), want)


def test_columns_hold_fewer_values_where_a_task_has_few_rows():
    cuts = [range(31)] * 4 + [range(1)] * 8
    assert max(BN.Columns.of(cuts, 1000).sizes) <= BN.BINS
    assert BN.Columns.of(cuts, 10 ** 7) == BN.Columns.of(cuts) and max(BN.Columns.of(cuts).sizes) <= BN.JOINT


def test_walk_forward_blocks_hold_joint_columns_and_the_scores_in_use(monkeypatch):
    """A level reads a few joint columns and each fold's own rows; rows are drawn once a tree, not at every level."""
    rng, folds, n = np.random.default_rng(1), 3, 500
    cuts = [range(31), range(6)] + [range(1)] * 9
    columns = BN.Columns.of(cuts)
    bins = [rng.integers(0, len(c) + 1, n) for c in cuts]
    segment, y = rng.integers(0, folds + 1, n).astype(np.uint8), rng.normal(size=n)
    block = B.Block(0, 7, columns.joint(bins).tobytes(), y.tobytes(), None, segment.tobytes(), len(cuts), folds, columns)
    assert len(block.x) < len(cuts) / 3 and [len(s) for s in block.score] == [(segment <= f + 1).sum() for f in range(folds)]
    assert all(np.array_equal(block.trains(f), segment < f + 1) for f in range(folds))
    p = B.Boosting(max_depth=3, min_leaf=10)
    want = np.random.Generator(np.random.Philox(key=[p.seed + 1, 7])).random(n) < p.subsample
    tree = B.Tree(1, folds, p.max_depth)
    moved, = B._moved(iter([block]), tree, 0, p, folds)
    assert np.array_equal(moved._as_came(moved.drawn(p, 1)), want)
    monkeypatch.setattr(B.np.random, "Generator", None)
    assert np.array_equal(moved._as_came(moved.drawn(p, 1)), want)


def test_fit_blocks_hold_no_more_than_a_level_needs(monkeypatch):
    """A row is its joint values, one number and a bit or two; rows are drawn when the blocks move on."""
    rng, n = np.random.default_rng(2), 300
    columns = BN.Columns.of([range(11), range(6)])
    x, y = columns.joint([rng.integers(0, 12, n), rng.integers(0, 7, n)]), np.where(rng.random(n) < 0.4, 1.0, -1.0)
    for classify in (True, False):
        p = GR.Growth(3, 2, 0.1, 0.8, 5, 0.0, 42, classify, False)
        block = GR._block({"id": 9, "x": x.tobytes(), "y": y.tobytes(), "w": None}, 0, columns, p)
        size = sum(getattr(block, a).nbytes for a in ("x", "state", "ones", "bits") if getattr(block, a) is not None)
        assert size <= n * (2 * len(x) + 8) + 2 * (n // 8 + 1)
        rows = np.flatnonzero(block.drawn())
        assert np.array_equal(block.residuals(0, rows), y[rows])
        tree = GR.Tree(p.max_depth)
        tree.value[:] = 0.25
        moved, = GR._moved(iter([block]), {0: tree}, 0, p, [columns])
        want = 4 * y / (1 + np.exp(0.5 * y)) if classify else 2 * (y - 0.25)
        assert np.allclose(moved.residuals(1, np.arange(n)), want)
        assert np.array_equal(moved.drawn(), np.random.Generator(np.random.Philox(key=[43, 9])).random(n) < 0.8)


def test_blocks_are_dealt_out_evenly(spark):
    rows = spark.sparkContext.parallelize([range(9), range(1), range(0), range(6)], 4).flatMap(list)
    assert sorted(map(len, BN.dealt(rows, 4).glom().collect())) == [4, 4, 4, 4]


def test_dealt_blocks_grow_the_model_of_dealt_rows(spark, monkeypatch):
    """Of many rows, blocks are dealt out in place of rows."""
    from ridewise.operators import models as ML
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(float(a), float(b), float(a * b % 7)) for a, b in rng.integers(0, 9, (600, 2))], "a double, b double, y double").repartition(3)
    est = ML.gbt_regressor("y", max_iter=3, max_depth=3, min_leaf=5, subsample=1.0)
    seen, real = [], GR.dealt
    monkeypatch.setattr(GR, "dealt", lambda rows, parts: seen.append(parts) or real(rows, parts))
    want = ML.fit(df, ["a", "b"], est)
    assert seen == []
    monkeypatch.setattr(ML, "FIT_ROWS", 10)
    monkeypatch.setattr(ML, "DEAL_ROWS", 20)
    got = ML.fit(df, ["a", "b"], est)
    assert len(seen) == 1

    def values(m):
        return [r.pred for r in ML.score_regression(m, df).orderBy("a", "b").select("pred").collect()]

    assert np.allclose(values(got), values(want))
