"""Training jobs: per-city demand models and the wait / surge / cancellation models.

Each returns a metrics DataFrame (one row per scope and model) and, when a
model folder is given, stores the fitted pipelines with their metadata
(A8). Intermediate tables are read from the materialised enriched stage, so
every fit starts from a Parquet scan, not from the cleaning lineage.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewise.operators import metrics as M
from ridewise.operators.boosting import BINS, BLOCK_ROWS, TASK_ROWS, Boosting
from ridewise.operators import models as ML
from ridewise.operators import timeseries as G
from ridewise.operators.features import cyclical, is_cancelled

DEMAND_GBT = dict(max_depth=5, step=0.05, subsample=0.8, min_leaf=10)
WAIT_GBT = dict(max_depth=5, step=0.05, subsample=0.8, min_leaf=20)
SURGE_GBT = dict(max_depth=5, step=0.05, subsample=0.8, min_leaf=20)
CANCEL_GBT = dict(max_depth=4, step=0.05, subsample=0.8, min_leaf=30)
#: fixed values: boosting iterations
TREES, CANCEL_TREES = 200, 150
#: Digest of everything that decides what a training job stores.
PARAMETERS = hashlib.sha1(repr((
    DEMAND_GBT, WAIT_GBT, SURGE_GBT, CANCEL_GBT, TREES, CANCEL_TREES, BINS, TASK_ROWS, "growth", BLOCK_ROWS,
    G.DEMAND_FEATURES, ML.WAIT_FEATURES, ML.SURGE_FEATURES, ML.CANCEL_FEATURES)).encode()).hexdigest()[:12]


def cv_params(name: str) -> Boosting:
    """The parameters of a model's walk-forward folds: those of its final fit."""
    own = {"wait": WAIT_GBT, "surge": SURGE_GBT, "demand": DEMAND_GBT}[name]
    return Boosting(trees=TREES, classify=name == "surge", **own)


def demand_split(enriched: DataFrame) -> DataFrame:
    """Hourly demand rows of all cities with lag features and the per-city 80/20 role."""
    return G.hourly_split(G.city_dataset(G.hourly_dataset(enriched)))


def _row(df: DataFrame, scope: str, model: str) -> DataFrame:
    return df.withColumns({"scope": F.lit(scope), "model": F.lit(model)})


def train_demand(spark: SparkSession, enriched: DataFrame, max_iter: int = TREES,
                 cities: list[str] | None = None, model_dir: str | None = None,
                 return_models: bool = False, parallel: int = 5):
    """Per city: ridge baseline and boosted trees on the hourly series."""
    ds = demand_split(enriched).persist(StorageLevel.MEMORY_AND_DISK)   # hourly table: small
    # the validated city domain (≤ a handful of names)
    cities = cities or [r["city"] for r in ds.select("city").distinct().orderBy("city").collect()]
    feats = G.DEMAND_FEATURES

    def boosted():
        return ML.fit_groups(ds.where(F.col("role") == "train"), "city", cities, feats, ML.gbt_regressor("rides", max_iter=max_iter, **DEMAND_GBT))

    def one_city(city: str):
        c = ds.where(F.col("city") == city)
        train, test = c.where(F.col("role") == "train"), c.where(F.col("role") == "test")
        base = ML.ridge_baseline(train, test, feats, "rides", lo=0.0)
        model = grown.result()[city]
        scored = ML.score_regression(model, test, lo=0.0)
        met, bmet = M.regression_metrics(scored, "rides", "pred"), M.regression_metrics(base, "rides", "pred")
        if model_dir:
            ML.save_model(spark, model, model_dir, f"demand_{city.replace(' ', '_')}", "GBTRegressor", feats,
                          met.first().asDict(), city, "ridge", bmet.first().asDict())
        return city, model, [_row(bmet, city, "ridge"), _row(met, city, "gbt")]

    # Boosted trees grow for all cities (a bounded domain) at once; beside them the
    # baselines are submitted concurrently so their small stages share the cluster.
    with ThreadPoolExecutor(max_workers=1 + max(1, min(len(cities), parallel))) as pool:
        grown = pool.submit(boosted)
        done = list(pool.map(one_city, cities))
    rows = [r for _, _, rs in done for r in rs]
    models = {c: m for c, m, _ in done}
    if model_dir:
        ds.unpersist()
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return (out, models) if return_models else out


def ride_features(enriched: DataFrame) -> DataFrame:
    """Ride-level model table: cyclical encodings and the two binary targets."""
    return enriched.withColumns({**cyclical(),
                                 "is_high_surge": F.col("is_high_surge").cast("int"),
                                 "is_cancelled": is_cancelled()})


def ride_split(enriched: DataFrame) -> DataFrame:
    """Ride-level table with the 80/20 time-ordered role (boundary located by counting)."""
    return G.temporal_split(ride_features(enriched))


def train_wait(spark: SparkSession, split: DataFrame, max_iter: int = TREES, model_dir: str | None = None):
    """Wait-time regression (H3 ridge baseline, H6 boosted trees), clipped to [0.5, 120].

    The baseline and the boosted trees are independent distributed fits and
    are submitted concurrently.
    """
    train, test = split.where(F.col("role") == "train"), split.where(F.col("role") == "test")
    feats = ML.WAIT_FEATURES

    def baseline():
        base = ML.ridge_baseline(train, test, feats, "wait_time_min", lo=0.5, hi=120.0)
        return _row(M.regression_metrics(base, "wait_time_min", "pred"), "all", "ridge")

    def boosted():
        return ML.fit(train, feats, ML.gbt_regressor("wait_time_min", max_iter=max_iter, **WAIT_GBT))

    with ThreadPoolExecutor(max_workers=2) as pool:
        fb, fm = pool.submit(baseline), pool.submit(boosted)
        bmet, model = fb.result(), fm.result()
    scored = ML.score_regression(model, test, lo=0.5, hi=120.0)
    met = _row(M.regression_metrics(scored, "wait_time_min", "pred"), "all", "gbt")
    if model_dir:
        own, base = (x.drop("scope", "model").first().asDict() for x in (met, bmet))
        ML.save_model(spark, model, model_dir, "wait_time", "GBTRegressor", feats, own, None, "ridge", base)
    return met.unionByName(bmet), model, scored


def train_classifier(spark: SparkSession, split: DataFrame, label: str, features, params: dict,
                     max_iter: int = TREES, name: str = "surge", model_dir: str | None = None,
                     baseline: bool = True, balanced: bool = False):
    """Boosted-tree classifier (H7/H8) with optional logistic baseline (H4), fitted concurrently.

    ``balanced`` weights the positive rows by (1 - p) / p, p their share of the
    training rows.
    """
    train, test = split.where(F.col("role") == "train"), split.where(F.col("role") == "test")
    if balanced:
        train, params = class_weighted(train, label), params | {"weight_col": "class_weight"}

    def logistic():
        b = ML.logistic_baseline(train, test, features, label)
        return _row(M.classification_metrics(b, label, "pred", "score"), "all", "logistic")

    with ThreadPoolExecutor(max_workers=2) as pool:
        fb = pool.submit(logistic) if baseline else None
        model = ML.fit(train, features, ML.gbt_classifier(label, max_iter=max_iter, **params))
        bmet = fb.result() if fb else None
    scored = ML.score_classifier(model, test)
    met = _row(M.classification_metrics(scored, label, "pred", "score"), "all", "gbt")
    if bmet is not None:
        met = met.unionByName(bmet)
    if model_dir:
        by_model = {r["model"]: {k: r[k] for k in ("auc", "precision", "recall", "f1")} for r in met.collect()}      # at most two rows
        ML.save_model(spark, model, model_dir, name, "GBTClassifier", features, by_model["gbt"], None,
                      "logistic" if baseline else None, by_model.get("logistic"))
    return met, model, scored


def class_weighted(train: DataFrame, label: str) -> DataFrame:
    """H7: column ``class_weight``: (1 - p) / p for positive rows, 1 for the others; p from one aggregate."""
    positive = train.agg(F.avg(F.col(label).cast("double"))).scalar()
    return train.withColumn("class_weight", F.when(F.col(label) == 1, (1 - positive) / positive).otherwise(F.lit(1.0)))


def model_jobs(spark: SparkSession, enriched: DataFrame, split: DataFrame, model_dir: str,
               trees: int = TREES, cancel_trees: int = CANCEL_TREES) -> dict:
    """The four training jobs by name; each stores its models when it is called.

    A job gives (metrics, model or models by city, scored test rows or None).
    """
    return {
        "wait": lambda: train_wait(spark, split, max_iter=trees, model_dir=model_dir),
        "surge": lambda: train_classifier(spark, split, "is_high_surge", ML.SURGE_FEATURES, SURGE_GBT, max_iter=trees,
                                          name="surge", model_dir=model_dir),
        "cancellation": lambda: train_classifier(spark, split, "is_cancelled", ML.CANCEL_FEATURES, CANCEL_GBT,
                                                 max_iter=cancel_trees, name="cancellation", model_dir=model_dir, baseline=False),
        "demand": lambda: (*train_demand(spark, enriched, max_iter=trees, model_dir=model_dir, return_models=True), None),
    }
