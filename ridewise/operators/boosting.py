"""Walk-forward boosted trees, all folds and groups grown together.

Walk-forward validation fits one model a fold (and a city): with one fit after
the other, the start of a few Spark jobs a tree is most of the time. Here one
binned matrix is stored once and shared by every model: a row carries its group
and the fold it validates (``segment``), and model f of a group trains on the
rows with ``segment < f``. All models grow level by level in lockstep, so a tree
costs one job a level whatever the number of folds and cities: each task adds
up (weight, residual, curvature) by model, node, feature and bin, the sums are
merged as a tree, and the driver, which sees models x nodes x features x bins
numbers and no row, takes the best splits.

Blocks of rows are numpy arrays in a cached RDD: the state of boosting (the
score of each row under each model) changes from tree to tree within its
partition, which no DataFrame operator expresses. The lineage is cut by
checkpoints. Rows are drawn for a tree by a counter-based generator keyed by
tree and block, so a recomputed partition draws the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridewise.functions.columns import round_np
from ridewise.functions.joins import proven_broadcast
from ridewise.functions.lineage import cut_lineage, discard, store
from ridewise.operators import metrics as M
from ridewise.operators.binned import BINS, Columns, Paths, add, dealt, lighter_slots, paired, taken
from ridewise.session import checkpoint_dir

#: Rows a block, trees between two checkpoints of the rows' scores.
BLOCK_ROWS, CHECKPOINT_TREES = 1 << 17, 50
#: Rows that make a task worth its start, which every level of every tree pays, and blocks that one may hold.
TASK_ROWS, TASK_BLOCKS = 1 << 14, 16
#: Partial sums merged at once before they reach the driver.
MERGE_DEPTH = 2


@dataclass(frozen=True)
class Boosting:
    """Parameters of one run; ``classify`` takes log-loss on a 0/1 label, else squared error."""

    trees: int = 200
    max_depth: int = 5
    step: float = 0.05
    subsample: float = 0.8
    min_leaf: float = 10
    classify: bool = False
    seed: int = 42


# -- binning -----------------------------------------------------------------------

def bin_edges(rows: DataFrame, features: Sequence[str], group: str) -> tuple[dict, int]:
    """{group: a list of ascending cut values for each feature}, from quantiles, and the number of rows.

    Between two cuts lie equal shares of a group's rows; a feature of at most
    BINS values has one bin a value. Groups are a validated domain (cities).
    Values are counted first, so that quantiles are told of the features that need them
    and only features of a bounded number of values are collected.
    """
    shares = F.array(*(F.lit(i / BINS) for i in range(1, BINS)))
    v = [F.col(c).cast("double") + F.lit(0.0) for c in features]                 # one zero
    about = rows.groupBy(group).agg(*(F.approx_count_distinct(x) for x in v)).collect()
    # the estimate is near exact for small numbers; its margin decides nothing but what is collected
    few = [i for i in range(len(v)) if any(r[1 + i] <= 4 * BINS for r in about)]
    own = {i: F.when(F.col(group).isin([r[0] for r in about if r[1 + i] <= 4 * BINS]), v[i]) for i in few}
    values = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *(F.sort_array(F.collect_set(x)) for x in own.values())).collect()
    found = {r[0]: {i: r[2 + j] for j, i in enumerate(few) if 0 < len(r[2 + j]) <= BINS} for r in values}
    many = [i for i in range(len(v)) if any(i not in f for f in found.values())]
    cuts = rows.groupBy(group).agg(F.count(F.lit(1)), *(F.percentile_approx(F.col(features[i]).cast("double"), shares, 10_000) for i in many)).collect() if many else []
    out = {g: [f[i][:-1] if i in f else [] for i in range(len(v))] for g, f in found.items()}
    for r in cuts:
        for j, i in enumerate(many):
            if i not in found[r[0]]:
                out[r[0]][i] = sorted(set(r[2 + j] or ()))
    return out, sum(r["n"] for r in values)


_BLOCK = "grp int, block long, x binary, y binary, w binary, segment binary"


def _packer(features: Sequence[str], names: list, edges: list, columns: list[Columns], weighted: bool):
    index = {g: i for i, g in enumerate(names)}

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[pd.DataFrame]] = {}
        size: dict[int, int] = {}

        def packed(g):
            rows = pd.concat(held.pop(g), ignore_index=True)
            size.pop(g)
            # a null goes with the least values
            x = columns[g].joint([np.searchsorted(np.array(edges[g][i]), np.nan_to_num(rows[c].to_numpy(float), nan=-np.inf), side="left") for i, c in enumerate(features)])
            w = rows["w"].to_numpy(np.float64).tobytes() if weighted else None
            return pd.DataFrame([(g, int(rows["id"].iloc[0]), x.tobytes(), rows["y"].to_numpy(np.float64).tobytes(), w,
                                  rows["segment"].to_numpy(np.uint8).tobytes())], columns=[c.split()[0] for c in _BLOCK.split(", ")])

        for frame in frames:
            for name, rows in frame.groupby("grp", sort=True):
                g = index[name]
                held.setdefault(g, []).append(rows)
                size[g] = size.get(g, 0) + len(rows)
                if size[g] >= BLOCK_ROWS:
                    yield packed(g)
        for g in sorted(held):
            yield packed(g)

    return pack


class Block:
    """Rows of one group in order of their segments: joint values (column x row), label, weight (None: 1 each), and each fold's scores so far.

    Fold f's model trains on the first ``ends[f]`` rows and is validated on those
    up to ``ends[f + 1]``; it has scores for these only. ``order`` has the rows'
    places as they came, by which they are drawn. Without ``columns`` x has each
    feature's bins.
    """

    def __init__(self, grp, number, x, y, w, segment, n_features, folds, columns: Columns | None = None):
        self.grp, self.number = grp, number
        segment = np.frombuffer(segment, np.uint8)
        order, n = np.argsort(segment, kind="stable"), len(segment)
        if columns is None:
            columns = Columns.of([range(BINS - 1)] * n_features)
            x = columns.joint(np.frombuffer(x, np.uint8).reshape(n_features, n))
        else:
            x = np.frombuffer(x, np.uint16).reshape(len(columns.sizes), n)
        self.columns, self.order, self.bits = columns, order.astype(np.uint32), None
        self.x, self.y = np.ascontiguousarray(x[:, order]), np.frombuffer(y, np.float64)[order]
        self.w = None if w is None else np.frombuffer(w, np.float64)[order]
        self.ends = np.searchsorted(segment[order], np.arange(1, folds + 2)).tolist()
        self.score = [np.zeros(end) for end in self.ends[1:]]

    def trains(self, f: int) -> np.ndarray:
        """Which rows, as they came, fold f's model trains on."""
        return self._as_came(np.arange(len(self.y)) < self.ends[f])

    def nodes(self, f: int, tree: Tree) -> np.ndarray:
        """Where each row, as it came, stands in fold f's tree (0 is the root, children of i are 2i+1 and 2i+2; leaves stay)."""
        paths = tree.paths(self.grp, f, self.columns)
        return self._as_came(paths.ends.take(paths.places(self.x)))

    def _as_came(self, values: np.ndarray) -> np.ndarray:
        out = np.empty_like(values)
        out[self.order] = values
        return out

    def draw(self, p: Boosting, number: int) -> np.ndarray:
        """The rows that a tree is grown on, as bits."""
        g = np.random.Generator(np.random.Philox(key=[p.seed + number, self.number & (2 ** 63 - 1)]))
        return np.packbits((g.random(len(self.y)) < p.subsample)[self.order])

    def drawn(self, p: Boosting, number: int) -> np.ndarray:
        bits = self.draw(p, number) if self.bits is None else self.bits
        return np.unpackbits(bits, count=len(self.y)).view(bool)

    def residuals(self, f: int, classify: bool, use: np.ndarray) -> np.ndarray:
        """The residuals of the rows ``use`` under fold f's model."""
        score = self.score[f].take(use)
        return self.y.take(use) - (1 / (1 + np.exp(-score)) if classify else score)

    def moved(self, score: list[np.ndarray], bits: np.ndarray | None = None) -> Block:
        """The block with other scores, and the rows that the next tree is grown on."""
        new = Block.__new__(Block)
        new.__dict__.update(self.__dict__)
        new.score, new.bits = score, bits
        return new


class Tree:
    """One tree for each group and fold: split feature (-1: leaf), last bin that goes left, and value by node."""

    def __init__(self, groups: int, folds: int, max_depth: int):
        n = 2 ** (max_depth + 1) - 1
        self.feature = np.full((groups, folds, n), -1, np.int16)
        self.bin = np.zeros((groups, folds, n), np.uint8)
        self.value = np.zeros((groups, folds, n))
        self.levels = 0

    def paths(self, group: int, f: int, columns: Columns) -> Paths:
        return Paths(self.feature[group, f], self.bin[group, f], self.levels, columns)


# -- one job a level ------------------------------------------------------------------

def _sums(blocks: RDD, tree: Tree, number: int, p: Boosting, features: int, folds: int,
          above: dict[int, np.ndarray] | None = None) -> dict[int, np.ndarray]:
    """{group: sums (kind, fold, node of the deepest level, feature, bin)} of weight, weighted residual and, to classify, curvature.

    Below the root the tasks add up one child of each split, the lighter one;
    its sibling is the rest of ``above``, the sums of the level before.
    """
    kinds = 3 if p.classify else 2                  # the squared error's curvature is the weight
    light = {} if above is None else {g: _lighter(tree, g, v[0]) for g, v in above.items()}

    def partial(part: Iterator[Block]) -> Iterator[dict[int, np.ndarray]]:
        total: dict[int, tuple] = {}
        for block in part:
            g, own, slots = block.grp, block.columns, max(1, 2 ** tree.levels // 2)
            if g not in total:
                paths = [tree.paths(g, f, own) if tree.levels else None for f in range(folds)]
                ways = [(way, None if way is None else lighter_slots(way.ends, light[g][f])) for f, way in enumerate(paths)]
                total[g] = own, ways, *([[np.zeros((slots, size), kind) for size in own.sizes] for _ in range(folds)] for kind in (complex, float)[:kinds - 1])
            _, ways, *sums = total[g]
            drawn = block.drawn(p, number)
            for f in range(folds):
                end = block.ends[f]
                use, slot = taken(*ways[f], block.x[:, :end], drawn[:end])
                if not len(use):
                    continue
                r, w = block.residuals(f, p.classify, use), None if block.w is None else block.w.take(use)
                values = [(sums[0][f], paired(1.0, r) if w is None else paired(w, w * r))]
                if p.classify:
                    curve = np.abs(r) * (1 - np.abs(r))
                    values.append((sums[1][f], curve if w is None else w * curve))
                add(block.x, use, slot, *values)
        yield {g: np.stack([own.apart([np.stack([v.real, v.imag, *(s[f][c] for s in sums[1:])]) for c, v in enumerate(sums[0][f])]) for f in range(folds)], axis=1)
               for g, (own, _, *sums) in total.items()}

    def merged(a, b):
        for g, v in b.items():
            a[g] = a[g] + v if g in a else v
        return a

    sums = blocks.mapPartitions(partial)
    found = sums.treeReduce(merged, MERGE_DEPTH) if sums.getNumPartitions() > 32 else sums.reduce(merged)
    return found if above is None else {g: _both(tree, g, light[g], v, above[g]) for g, v in found.items()}


def _lighter(tree: Tree, g: int, weight: np.ndarray) -> np.ndarray:
    """For each fold and node of the level above the deepest: 0 if its left child weighs less, 1 if the right one does, -1 for a leaf."""
    folds, nodes = weight.shape[:2]
    first = nodes - 1
    feature, cut = tree.feature[g][:, first:first + nodes], tree.bin[g][:, first:first + nodes]
    f, n = np.meshgrid(np.arange(folds), np.arange(nodes), indexing="ij")
    by_bin = weight[f, n, np.maximum(feature, 0)]
    left = np.where(np.arange(BINS) <= cut[..., None], by_bin, 0).sum(axis=2)
    return np.where(feature < 0, -1, left * 2 > by_bin.sum(axis=2)).astype(np.int8)


def _both(tree: Tree, g: int, light: np.ndarray, own: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Sums of both children of every split: the added up one and the rest of its parent."""
    kinds, folds, nodes, features, bins = above.shape
    rest = np.where((light >= 0)[None, :, :, None, None], above - own, 0.0)
    first = (light == 0)[None, :, :, None, None]
    pair = np.stack([np.where(first, own, rest), np.where(first, rest, own)], axis=3)
    return pair.reshape(kinds, folds, 2 * nodes, features, bins)


def _grow(tree: Tree, sums: dict[int, np.ndarray], p: Boosting) -> None:
    """Splits the deepest level's nodes where that lowers the squared error of residuals most."""
    first = 2 ** tree.levels - 1
    for g, (w, r, *curve) in sums.items():
        h = curve[0] if curve else w
        left_w, left_r, left_h = (np.cumsum(v, axis=3) for v in (w, r, h))
        all_w, all_r, all_h = (v[..., -1:] for v in (left_w, left_r, left_h))
        right_w, right_r = all_w - left_w, all_r - left_r
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_r ** 2 / left_w + right_r ** 2 / right_w - all_r ** 2 / all_w
        gain[~((left_w >= p.min_leaf) & (right_w >= p.min_leaf))] = -1
        folds, nodes, features, bins = gain.shape
        flat = gain.reshape(folds, nodes, -1)
        top = flat.max(axis=2, keepdims=True)
        # of equal splits the first one, whatever order the sums were added in
        best = (flat >= top - 1e-9 * np.abs(top)).argmax(axis=2)
        feature, cut = best // bins, best % bins
        f, n = np.meshgrid(np.arange(folds), np.arange(nodes), indexing="ij")

        def leaf(residual, curve):
            return p.step * np.divide(residual, curve, out=np.zeros_like(residual), where=curve > 1e-12)

        lr, lh = left_r[f, n, feature, cut], left_h[f, n, feature, cut]
        ar, ah = all_r[f, n, 0, 0], all_h[f, n, 0, 0]
        there = all_w[f, n, 0, 0] > 0
        if tree.levels == 0:
            tree.value[g, :, 0] = leaf(ar, ah)[:, 0]
        split = (gain[f, n, feature, cut] > 1e-12) & there
        at = first + n
        tree.feature[g][f[split], at[split]] = feature[split]
        tree.bin[g][f[split], at[split]] = cut[split]
        tree.value[g][f[split], 2 * at[split] + 1] = leaf(lr, lh)[split]
        tree.value[g][f[split], 2 * at[split] + 2] = leaf(ar - lr, ah - lh)[split]
    tree.levels += 1


def _starts(blocks: RDD, groups: int, folds: int, classify: bool) -> np.ndarray:
    """The constant that each model begins with: the mean label, or its log-odds."""
    def partial(part):
        out = np.zeros((2, groups, folds))
        for b in part:
            for f, end in enumerate(b.ends[:folds]):
                y = b.y[:end]
                out[:, b.grp, f] += (end, y.sum()) if b.w is None else (b.w[:end].sum(), (b.w[:end] * y).sum())
        yield out

    w, y = blocks.mapPartitions(partial).reduce(np.add)
    mean = np.divide(y, w, out=np.zeros_like(y), where=w > 0)
    if not classify:
        return mean
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return np.log(mean / (1 - mean))


def _moved(part: Iterator[Block], tree: Tree, number: int, p: Boosting, folds: int) -> Iterator[Block]:
    """The blocks with a tree's values added to their scores."""
    ways: dict[int, list] = {}
    for b in part:
        if b.grp not in ways:
            paths = [tree.paths(b.grp, f, b.columns) for f in range(folds)]
            ways[b.grp] = [(way, tree.value[b.grp, f][way.ends]) for f, way in enumerate(paths)]
        score = [b.score[f] + values.take(way.places(b.x[:, :b.ends[f + 1]])) for f, (way, values) in enumerate(ways[b.grp])]
        yield b.moved(score, b.draw(p, number + 1))


def walk_forward(rows: DataFrame, features: Sequence[str], label: str, params: Boosting, n_splits: int = 5,
                 group: str | None = None, weight: str | None = None, id_col: str | None = None) -> DataFrame:
    """Validation rows of every fold with the prediction of the model that saw only earlier rows.

    rows: features, label and ``segment`` (0: trained on only; f: validates
    model f; models train on all smaller segments), and the group, weight and
    id columns if named. Gives (scope, fold, y, pred): scope is the group's
    name ('all' without one); pred is a probability when ``classify``. Rows
    without label or segment take no part; a null feature counts as least.
    """
    spark = rows.sparkSession
    checkpoint_dir(spark)
    data = rows.where(F.col(label).isNotNull() & F.col("segment").isNotNull()).select(
        (F.col(group) if group else F.lit("all")).alias("grp"), *(F.col(c).cast("double").alias(c) for c in features),
        F.col(label).cast("double").alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
        F.col("segment").cast("int").alias("segment"), F.xxhash64(id_col or label).alias("id"))
    edges, n = bin_edges(data, features, "grp")
    names = sorted(edges)
    schema = "scope string, fold int, y double, pred double"
    if not names:
        return spark.createDataFrame([], schema)
    cores = spark.sparkContext.defaultParallelism
    tasks = min(ceil(n / TASK_ROWS), cores * ceil(n / (cores * TASK_BLOCKS * BLOCK_ROWS)))
    columns = [Columns.of(edges[g], n // tasks) for g in names]
    packed, copy = store(data.coalesce(tasks).mapInPandas(_packer(list(features), names, [edges[n] for n in names], columns, weight is not None), _BLOCK), "binned")
    k, folds, groups = len(features), n_splits, len(names)
    blocks = dealt(packed.rdd, tasks).map(lambda r: Block(*r, k, folds, columns[r[0]])).persist(StorageLevel.MEMORY_AND_DISK)
    start = _starts(blocks, groups, folds, params.classify)
    state = blocks.map(lambda b: b.moved([np.full(len(s), start[b.grp, f]) for f, s in enumerate(b.score)])).persist(StorageLevel.MEMORY_AND_DISK)
    held = [blocks, state]
    for number in range(params.trees):
        tree = Tree(groups, folds, params.max_depth)
        sums = None
        for _ in range(params.max_depth):
            sums = _sums(state, tree, number, params, k, folds, sums)
            _grow(tree, sums, params)
        for old in held[:-1]:
            old.unpersist()

        state = state.mapPartitions(lambda part, tree=tree, number=number: _moved(part, tree, number, params, folds)).persist(StorageLevel.MEMORY_AND_DISK)
        if number % CHECKPOINT_TREES == CHECKPOINT_TREES - 1:
            state.checkpoint()
        held = [held[-1], state]

    def validated(b: Block):
        for f in range(folds):
            here = slice(b.ends[f], b.ends[f + 1])
            score = b.score[f][here]
            pred = 1 / (1 + np.exp(-score)) if params.classify else score
            yield (names[b.grp], f + 1, b.y[here].tolist(), pred.tolist())

    try:
        out = spark.createDataFrame(state.flatMap(validated), "scope string, fold int, y array<double>, pred array<double>")
        return cut_lineage(out.select("scope", "fold", F.inline(F.arrays_zip("y", "pred"))), "validated")
    finally:
        for old in held:
            old.unpersist()
        discard(spark, copy)


# -- results -----------------------------------------------------------------------------

def walk_forward_mean(rows: DataFrame, label: str, group: str | None = None) -> DataFrame:
    """The plainest predictor, for comparison: each fold is predicted by the mean label of the smaller segments.

    Gives (scope, fold, y, pred) as ``walk_forward`` does; sums by segment (a
    few rows) are accumulated and joined to the rows.
    """
    data = rows.where(F.col(label).isNotNull() & F.col("segment").isNotNull()).select(
        (F.col(group) if group else F.lit("all")).alias("scope"), F.col("segment").cast("int").alias("fold"), F.col(label).cast("double").alias("y"))
    before = Window.partitionBy("scope").orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    means = data.groupBy("scope", "fold").agg(F.sum("y").alias("s"), F.count("y").alias("n")).select(
        "scope", "fold", (F.sum("s").over(before) / F.sum("n").over(before)).alias("pred"))
    return data.join(proven_broadcast(means), ["scope", "fold"]).where("fold > 0").select("scope", "fold", "y", "pred")


def cv_scores(validated: DataFrame, classify: bool = False, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Metrics of each scope and fold of rows (scope, fold, y, pred), with the mean and population std of the folds.

    Regression: MAE, RMSE, R2, MAPE of predictions clipped to [lo, hi], and
    mean and std of MAE and mean of R2. Classification: exact AUC, and its mean
    and std. ``n`` is the number of rows that a fold validates.
    """
    folds = Window.partitionBy("scope")
    if classify:
        keys = [tuple(r) for r in validated.select("scope", "fold").distinct().orderBy("scope", "fold").collect()]     # scopes x folds
        own = [M.auc(validated.where((F.col("scope") == s) & (F.col("fold") == f)), "y", "pred").select(
            F.lit(s).alias("scope"), F.lit(f).alias("fold"), "auc") for s, f in keys]
        if not own:
            return validated.select("scope", "fold", *(F.lit(None).cast("double").alias(c) for c in ("auc", "mean_auc", "std_auc"))).limit(0)
        rows = own[0]
        for r in own[1:]:
            rows = rows.unionByName(r)
        return rows.select("scope", "fold", round_np("auc", 4).alias("auc"), round_np(F.avg("auc").over(folds), 4).alias("mean_auc"),
                           round_np(F.stddev_pop("auc").over(folds), 4).alias("std_auc"))
    pred = F.col("pred")
    if lo is not None:
        pred = F.greatest(pred, F.lit(lo))
    if hi is not None:
        pred = F.least(pred, F.lit(hi))
    clipped = validated.withColumn("pred", pred)
    exact = clipped.groupBy("scope", "fold").agg(F.avg(F.abs(F.col("y") - F.col("pred"))).alias("exact"))
    rows = M.regression_metrics(clipped, "y", "pred", by=("scope", "fold")).join(exact, ["scope", "fold"])
    return rows.withColumns({"mean_mae": round_np(F.avg("exact").over(folds), 4), "std_mae": round_np(F.stddev_pop("exact").over(folds), 4),
                             "mean_r2": round_np(F.avg("r2").over(folds), 4)}).drop("exact")
