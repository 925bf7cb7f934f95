"""Lockstep boosting against a plain version, and its folds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridewise.operators import boosting as B


def plain_tree(x, y, r, h, depth, min_leaf):
    """Exhaustive least-squares splits on residuals r; leaf value sum(r) / sum(h)."""
    value = r.sum() / h.sum() if h.sum() > 1e-12 else 0.0
    best = (1e-12, None, None)
    if depth:
        for f in range(x.shape[1]):
            for t in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= t
                a, b = left.sum(), (~left).sum()
                if a < min_leaf or b < min_leaf:
                    continue
                gain = r[left].sum() ** 2 / a + r[~left].sum() ** 2 / b - r.sum() ** 2 / len(r)
                if gain > best[0] + 1e-9:
                    best = (gain, f, t)
    if best[1] is None:
        return lambda q: np.full(len(q), value)
    _, f, t = best
    left = x[:, f] <= t
    low, high = (plain_tree(x[m], y[m], r[m], h[m], depth - 1, min_leaf) for m in (left, ~left))
    return lambda q: np.where(q[:, f] <= t, low(q), high(q))


def plain_boosting(x, y, q, p):
    mean = y.mean()
    score, out = np.full(len(y), mean), np.full(len(q), mean)
    if p.classify:
        score[:], out[:] = np.log(mean / (1 - mean)), np.log(mean / (1 - mean))
    for _ in range(p.trees):
        pred = 1 / (1 + np.exp(-score)) if p.classify else score
        r = y - pred
        tree = plain_tree(x, y, r, pred * (1 - pred) if p.classify else np.ones(len(y)), p.max_depth, p.min_leaf)
        score, out = score + p.step * tree(x), out + p.step * tree(q)
    return 1 / (1 + np.exp(-out)) if p.classify else out


def table(spark, n, seed, classify=False):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.integers(0, 20, n), rng.integers(0, 5, n), rng.integers(0, 2, n)].astype(float)
    y = x[:, 0] * 0.7 + np.where(x[:, 1] > 2, 5, 0) * x[:, 2] + rng.normal(size=n)
    if classify:
        y = (y + rng.normal(size=n) > 7).astype(float)
    segment, city = np.arange(n) * 6 // n, np.array(["A", "B"])[rng.integers(0, 2, n)]
    rows = [(int(i), str(c), *map(float, v), float(t), int(s)) for i, (c, v, t, s) in enumerate(zip(city, x, y, segment))]
    return spark.createDataFrame(rows, "id long, city string, a double, b double, c double, y double, segment int"), x, y, segment, city


@pytest.mark.parametrize("classify", [False, True])
def test_every_fold_and_city_equals_its_own_plain_fit(spark, classify):
    df, x, y, segment, city = table(spark, 600, 3, classify)
    p = B.Boosting(trees=6, max_depth=3, step=0.3, subsample=1.0, min_leaf=5, classify=classify)
    got = B.walk_forward(df.repartition(3), ["a", "b", "c"], "y", p, group="city", id_col="id").toPandas()
    assert len(got) == (segment > 0).sum()
    for name in "AB":
        for f in range(1, 6):
            train, valid = (city == name) & (segment < f), (city == name) & (segment == f)
            want = plain_boosting(x[train], y[train], x[valid], p)
            own = got[(got.scope == name) & (got.fold == f)]
            assert np.allclose(np.sort(own.pred), np.sort(want), atol=1e-9)
            assert sorted(own.y) == sorted(y[valid])


def test_weights_act_like_copies(spark):
    df, *_ = table(spark, 300, 4, True)
    p = B.Boosting(trees=4, max_depth=2, step=0.3, subsample=1.0, min_leaf=1, classify=True)
    heavy = df.withColumn("w", F.when(F.col("y") == 1, 3.0).otherwise(1.0))
    copies = df.withColumn("k", F.explode(F.when(F.col("y") == 1, F.array(*map(F.lit, (1, 2, 3)))).otherwise(F.array(F.lit(1)))))
    a = B.walk_forward(heavy, ["a", "b", "c"], "y", p, weight="w", id_col="id").toPandas()
    b = B.walk_forward(copies, ["a", "b", "c"], "y", p, id_col="id").toPandas().drop_duplicates()
    plain = B.walk_forward(df, ["a", "b", "c"], "y", p, id_col="id").toPandas()
    assert np.allclose(np.unique(a.pred.round(9)), np.unique(b.pred.round(9)))
    assert not np.allclose(np.sort(a.pred), np.sort(plain.pred))


def test_bins_of_many_values_nulls_and_no_rows(spark):
    rows = [(i, None if i % 50 == 0 else float(i), float(i % 7), i * 6 // 2000) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, a double, y double, segment int")
    edges = B.bin_edges(df.select(F.lit("all").alias("grp"), "a"), ["a"], "grp")[0]["all"][0]
    assert 25 <= len(edges) < B.BINS and edges == sorted(edges)
    p = B.Boosting(trees=2, subsample=0.8)
    got = B.walk_forward(df.withColumn("scope", F.lit(1)), ["a"], "y", p, id_col="id")
    assert got.count() == sum(s > 0 for *_, s in rows) and got.where("pred is null or isnan(pred)").count() == 0
    assert B.walk_forward(df.limit(0), ["a"], "y", p).count() == 0
    again = B.walk_forward(df, ["a"], "y", p, id_col="id")
    assert got.exceptAll(again).count() == 0


def test_scores_of_folds(spark):
    rows = [("x", 1, 1.0, 2.0), ("x", 1, 3.0, 2.0), ("x", 2, 5.0, 2.0), ("y", 1, 0.0, 0.5)]
    got = {(r.scope, r.fold): r for r in B.cv_scores(spark.createDataFrame(rows, "scope string, fold int, y double, pred double")).collect()}
    assert got["x", 1].mae == 1.0 and got["x", 2].mae == 3.0 and got["x", 1].mean_mae == 2.0 and got["x", 2].std_mae == 1.0 and got["y", 1].n == 1
    rows = [("all", f, float(i % 2), (i * 7 % 5) / 5 if f == 1 else float(i % 2)) for f in (1, 2) for i in range(10)]
    got = {r.fold: r for r in B.cv_scores(spark.createDataFrame(rows, "scope string, fold int, y double, pred double"), classify=True).collect()}
    assert got[2].auc == 1.0 and abs(got[1].mean_auc - (got[1].auc + 1) / 2) < 1e-4


def test_sums_of_both_children_from_the_lighter_one(monkeypatch):
    """a level adds up one child of each split; its sibling is the rest of the parent's sums."""
    class Rdd:
        def __init__(self, items):
            self.items = items

        def mapPartitions(self, f):
            return Rdd(list(f(iter(self.items))))

        def getNumPartitions(self):
            return 1

        def reduce(self, f):
            return self.items[0]

    g = np.random.default_rng(3)
    n, k, folds = 4000, 3, 2
    x = g.integers(0, B.BINS, (k, n)).astype(np.uint8)
    y = (x[0] > 20).astype(float) + g.normal(0, 0.1, n)
    block = B.Block(0, 5, x.tobytes(), y.tobytes(), np.ones(n).tobytes(), g.integers(0, 3, n).astype(np.uint8).tobytes(), k, folds)
    p = B.Boosting(max_depth=4, min_leaf=40)
    tree, sums, added = B.Tree(1, folds, p.max_depth), None, []
    count = np.bincount
    monkeypatch.setattr(B.np, "bincount", lambda at, w, size: added.append(len(at)) or count(at, w, size))
    for level in range(p.max_depth):
        added.clear()
        sums = B._sums(Rdd([block]), tree, 0, p, k, folds, sums)
        half = sum(added)
        added.clear()
        whole = B._sums(Rdd([block]), tree, 0, p, k, folds) if level == 0 else None
        if level:
            assert half <= before / 2
        else:
            before = sum(added)
            np.testing.assert_allclose(sums[0], whole[0])
        drawn = np.random.Generator(np.random.Philox(key=[p.seed, block.number])).random(n) < p.subsample
        for f in range(folds):
            node = block.nodes(f, tree) - (2 ** level - 1)
            use = drawn & block.trains(f) & (node >= 0)
            for kind, v in enumerate((np.ones(n), y)):
                want = np.zeros((2 ** level, k, B.BINS))
                for c in range(k):
                    np.add.at(want[:, c], (node[use], x[c, use]), v[use])
                np.testing.assert_allclose(sums[0][kind, f], want, atol=1e-9)
        B._grow(tree, sums, p)
