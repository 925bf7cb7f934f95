"""MLlib models (H1–H8, H15, H19; H13 is in ``boosting``) and model persistence.

Every model is a ``Pipeline(VectorAssembler → estimator)`` fit on a
DataFrame, so training is distributed (tree building aggregates statistics
over partitions). The one loop is over the 5 cities of the per-city demand
models, and each iteration is itself a distributed fit. Boosting iterations default to the reference's values and
are a parameter.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewise.functions.columns import round_np
from ridewise.functions.joins import proven_broadcast
from ridewise.operators import metrics as M
from ridewise.operators.boosting import bin_edges
from ridewise.operators.growth import Growth, as_model, grow
from ridewise.operators.scoring import CANCEL_FEATURES, SURGE_FEATURES, WAIT_FEATURES
from ridewise.operators.timeseries import DEMAND_FEATURES

LEAK_FREE_SURGE_FEATURES = [c for c in SURGE_FEATURES if c != "demand_pressure"]


# H1 ---------------------------------------------------------------------------------
def feature_vector(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out)


def _pipeline(features: Sequence[str], estimator) -> Pipeline:
    return Pipeline(stages=[feature_vector(features), estimator])


def scaler_stats(train: DataFrame, columns: Sequence[str]) -> tuple[int, list[float], list[float]]:
    """Row count, means and population std of ``columns`` in one pass.

    MLlib ``Summarizer`` over the assembled columns: one tree-aggregate;
    only 2·k numbers reach the driver.
    """
    from pyspark.ml.stat import Summarizer
    vec = VectorAssembler(inputCols=list(columns), outputCol="_v").transform(
        train.select(*[F.col(c).cast("double").alias(c) for c in columns])).select("_v")
    r = vec.select(Summarizer.metrics("count", "mean", "variance").summary(F.col("_v")).alias("s")).first()["s"]
    n = int(r["count"])
    means = [float(x) for x in r["mean"].toArray()]
    var_s = [float(x) for x in r["variance"].toArray()]
    stds = [(v * (n - 1) / n) ** 0.5 if n > 1 and v > 0 else 0.0 for v in var_s]
    return n, means, stds


def _apply_scaling(df: DataFrame, features: Sequence[str], means, stds) -> DataFrame:
    cols = {}
    for c, mu, sd in zip(features, means, stds):
        x = F.col(c).cast("double") - F.lit(mu)
        cols[c] = x / F.lit(sd) if sd > 0 else x * F.lit(0.0)
    return df.withColumns(cols)


def _linear(features: Sequence[str], model) -> Column:
    """A linear model's value as a column expression (its transform would carry the session to the tasks)."""
    total = F.lit(float(model.intercept))
    for c, w in zip(features, model.coefficients.toArray().tolist()):
        total = total + F.col(c) * F.lit(w)
    return total


# H3 ---------------------------------------------------------------------------------
def ridge_baseline(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                   alpha: float = 1.0, lo: float | None = 0.0, hi: float | None = None) -> DataFrame:
    """Ridge on population-std-scaled features; predictions clipped; returns scored test rows.

    regParam = α·σ_pop(y)/n reproduces the closed-form ridge solution, because
    the normal-equation solver also standardises the label. Count, feature
    statistics and the label's σ come from one summary pass.
    """
    n, means, stds = scaler_stats(train, [*features, label])
    sy = stds[-1] or 1.0
    lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol="pred",
                          regParam=alpha * sy / max(n, 1), elasticNetParam=0.0,
                          solver="normal", standardization=False)
    k = len(features)
    model = _pipeline(features, lr).fit(_apply_scaling(train, features, means[:k], stds[:k])).stages[-1]
    scored = _apply_scaling(test, features, means[:k], stds[:k])
    p = _linear(features, model)
    if lo is not None:
        p = F.greatest(p, F.lit(lo))
    if hi is not None:
        p = F.least(p, F.lit(hi))
    return scored.withColumn("pred", p)


# H4 ---------------------------------------------------------------------------------
def logistic_baseline(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                      c: float = 1.0, max_iter: int = 500) -> DataFrame:
    """L2 logistic regression with C = 1 (regParam = 1/(C·n)), scaled features."""
    n, means, stds = scaler_stats(train, features)
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (c * max(n, 1)),
                            elasticNetParam=0.0, standardization=False, maxIter=max_iter,
                            probabilityCol="probability", predictionCol="pred_d")
    model = _pipeline(features, lr).fit(_apply_scaling(train, features, means, stds)).stages[-1]
    score = 1 / (1 + F.exp(-_linear(features, model)))
    scored = _apply_scaling(test, features, means, stds).withColumn("score", score)
    return scored.withColumn("pred", (F.col("score") > 0.5).cast("int"))


# H5–H8 ------------------------------------------------------------------------------
def gbt_regressor(label: str, max_iter: int = 200, max_depth: int = 5, step: float = 0.05,
                  subsample: float = 0.8, min_leaf: int = 10, seed: int = 42) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol=label, predictionCol="pred", maxIter=max_iter,
                        maxDepth=max_depth, stepSize=step, subsamplingRate=subsample,
                        minInstancesPerNode=min_leaf, seed=seed)


def gbt_classifier(label: str, max_iter: int = 200, max_depth: int = 5, step: float = 0.05,
                   subsample: float = 0.8, min_leaf: int = 20, seed: int = 42,
                   weight_col: str | None = None) -> GBTClassifier:
    kw = {"weightCol": weight_col} if weight_col else {}
    return GBTClassifier(featuresCol="features", labelCol=label, predictionCol="pred_d", maxIter=max_iter,
                         maxDepth=max_depth, stepSize=step, subsamplingRate=subsample,
                         minInstancesPerNode=min_leaf, seed=seed, **kw)


#: Rows of a training set that make a partition worth its start, and rows that one may hold.
FIT_ROWS, FULL_ROWS = 50_000, 4_000_000
#: Rows a partition from which blocks, of up to 2**17 rows, are dealt out evenly enough.
DEAL_ROWS = 1 << 20


def fit(train: DataFrame, features: Sequence[str], estimator) -> PipelineModel:
    """One distributed fit of boosted trees, on partitions that are full.

    Boosting runs a few jobs a tree; on partitions of a few rows each, their
    start costs more than their work. A set that gives every core a partition
    is dealt out evenly, since each level of each tree waits for the largest one.
    The trees are grown by ``growth``; the model is MLlib's.
    """
    return fit_groups(train.withColumn("_all", F.lit("all")), "_all", ["all"], features, estimator)["all"]


def fit_groups(train: DataFrame, group: str, names: Sequence[str], features: Sequence[str], estimator) -> dict[str, PipelineModel]:
    """``fit`` for each named group of rows (a validated domain), all grown in lockstep: a level of all models is one job."""
    label, weight = estimator.getLabelCol(), estimator.getWeightCol() if estimator.isDefined("weightCol") else None
    data = train.where(F.col(group).isin(list(names))).select(*dict.fromkeys([group, *features, label, *([weight] if weight else [])])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        edges, n = bin_edges(data, features, group)
        if len(edges) < len(names):
            raise ValueError("no training rows")
        rows = {names[0]: n} if len(names) == 1 else dict(data.groupBy(group).count().collect())          # a row a group
        parts = [_parts(data, rows[g]) for g in names]
        own = [data.where(F.col(group) == g) for g in names]
        # a block holds an eighth of a row's bytes: where there are many, blocks are dealt out and not rows
        deal = parts if min(rows[g] // k for g, k in zip(names, parts)) >= DEAL_ROWS else None
        sets = own if deal else [_dealt(d, rows[g]) for d, g in zip(own, names)]
        trees = grow(sets, features, label, [edges[g] for g in names], Growth.of(estimator), weight, [rows[g] // k for g, k in zip(names, parts)], deal)
    finally:
        data.unpersist()
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        models = pool.map(lambda at: as_model(train.sparkSession, _pipeline(features, estimator), features, trees[at], edges[names[at]]), range(len(names)))
        return dict(zip(names, models))


def _dealt(data: DataFrame, n: int) -> DataFrame:
    """``data`` of ``n`` rows in few full partitions, or in equal ones, a multiple of the cores."""
    parts = _parts(data, n)
    return data.coalesce(parts) if n <= parts * FIT_ROWS else data.repartition(parts)


def _parts(data: DataFrame, n: int) -> int:
    parts, cores = max(1, math.ceil(n / FIT_ROWS)), data.sparkSession.sparkContext.defaultParallelism
    return parts if parts <= cores else cores * math.ceil(n / (cores * FULL_ROWS))


def score_regression(model: PipelineModel, df: DataFrame, lo: float | None = None,
                     hi: float | None = None) -> DataFrame:
    p = F.col("pred")
    if lo is not None:
        p = F.greatest(p, F.lit(lo))
    if hi is not None:
        p = F.least(p, F.lit(hi))
    return model.transform(df).withColumn("pred", p).drop("features")


def score_classifier(model: PipelineModel, df: DataFrame) -> DataFrame:
    out = model.transform(df)
    return (out.withColumns({"score": vector_to_array("probability")[1], "pred": F.col("pred_d").cast("int")})
               .drop("features", "rawPrediction", "probability", "pred_d"))


# H15 --------------------------------------------------------------------------------
def importances(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """Importances of the fitted trees by feature name, descending (bounded by #features)."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    return sorted(zip(features, map(float, values)), key=lambda fv: (-fv[1], fv[0]))


def feature_importance(entries: DataFrame, k: int | None = None) -> DataFrame:
    """(name, rank, feature, importance) of the stored models, the k greatest of each."""
    items = entries.select("name", F.posexplode("importances").alias("_i", "_f"))
    rows = items.select("name", (F.col("_i") + 1).alias("rank"), "_f.feature", "_f.importance")
    return rows.where(F.col("rank") <= k) if k else rows


# H19 --------------------------------------------------------------------------------
def stored_metrics(entries: DataFrame) -> DataFrame:
    """(name, model, metrics): the held-out metrics of every stored model and of its baseline."""
    own = entries.select("name", "city", F.lit("gbt").alias("model"), "metrics")
    return own.unionByName(entries.where("baseline is not null").select("name", "city", F.col("baseline").alias("model"), F.col("baseline_metrics").alias("metrics")))


def leaderboard(entries: DataFrame) -> DataFrame:
    """Regression models and baselines by scope, the demand average over cities, and the gain over the baseline in % of MAE."""
    rows = stored_metrics(entries)
    scope = F.coalesce("city", "name")
    rows = rows.where("metrics['mae'] is not null").select(scope.alias("scope"), "model", F.col("city").isNotNull().alias("_city"),
                                                           *(F.col("metrics")[c].alias(c) for c in ("mae", "rmse", "r2", "mape")))
    avg = rows.where("_city").groupBy("model").agg(*[round_np(F.avg(c), 4).alias(c) for c in ("mae", "rmse", "r2", "mape")]).withColumn("scope", F.lit("average"))
    own = rows.drop("_city").unionByName(avg)
    base = own.where("model <> 'gbt'").select("scope", F.col("mae").alias("_base"))
    gain = F.when(F.col("model") == "gbt", M.improvement_over_baseline("mae", "_base")).alias("gain_pct")
    return own.join(proven_broadcast(base), "scope", "left").select("scope", "model", "mae", "rmse", "r2", "mape", gain)


# A8 / A9 / J13 -------------------------------------------------------------------------
_ENTRY = ("name string, city string, model_type string, baseline string, features array<string>, metrics map<string,double>, "
          "baseline_metrics map<string,double>, importances array<struct<feature:string, importance:double>>, trained_at string")


def save_model(spark: SparkSession, model: PipelineModel, path: str, name: str, model_type: str, features: Sequence[str],
               metrics: dict, city: str | None = None, baseline: str | None = None, baseline_metrics: dict | None = None) -> None:
    """The MLlib model folder, then its entry in the registry, a one-row JSON table beside it.

    An entry says that the model is whole. It holds the held-out metrics of the
    model and of its baseline, and all importances.
    """
    model.write().overwrite().save(f"{path}/{name}/model")

    def numbers(d):
        return None if d is None else {k: None if v is None else float(v) for k, v in d.items()}

    entry = {"name": name, "city": city, "model_type": model_type, "baseline": baseline, "features": list(features),
             "metrics": numbers(metrics), "baseline_metrics": numbers(baseline_metrics),
             "importances": [{"feature": f, "importance": v} for f, v in importances(model, features)],
             "trained_at": time.strftime("%Y-%m-%dT%H:%M:%S")}
    spark.createDataFrame([(json.dumps(entry),)], "entry string").write.mode("overwrite").text(f"{path}/{name}/metadata")


def registry(spark: SparkSession, path: str, names: Sequence[str] | None = None) -> DataFrame:
    """The entries of the stored models (of the named ones), one row each."""
    try:
        raw = spark.read.text(f"{path}/*/metadata")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _ENTRY)
    rows = raw.select(F.from_json("value", _ENTRY).alias("m")).select("m.*")
    return rows.where(F.col("name").isin(list(names))) if names else rows


def store_folds(scores: DataFrame, path: str, name: str) -> None:
    """Put a model's walk-forward scores (``boosting.cv_scores``) into the registry."""
    scores.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}/folds")            # a row a scope and fold


def stored_folds(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{path}/{name}/folds")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def model_registry(spark: SparkSession, path: str, entries: DataFrame) -> DataFrame:
    """(name, metric, value, baseline_value, cv_mean, cv_std): MAE or AUC of every entry, fold figures where stored."""
    metric = F.when(F.col("metrics")["mae"].isNotNull(), "mae").otherwise("auc")
    rows = entries.select("name", "city", metric.alias("metric"), "metrics", "baseline_metrics").select(
        "name", F.coalesce("city", "name").alias("scope"), "metric", F.element_at("metrics", F.col("metric")).alias("value"),
        F.try_element_at("baseline_metrics", F.col("metric")).alias("baseline_value"))
    folds = [f.select((F.lit(name) if name != "demand" else F.col("scope")).alias("scope"), F.col(f"mean_{m}").alias("cv_mean"), F.col(f"std_{m}").alias("cv_std")).distinct()
             for name, m in (("wait_time", "mae"), ("surge", "auc"), ("demand", "mae")) if (f := stored_folds(spark, path, name)) is not None]
    if not folds:
        return rows.drop("scope").withColumns({c: F.lit(None).cast("double") for c in ("cv_mean", "cv_std")})
    every = folds[0]
    for f in folds[1:]:
        every = every.unionByName(f)
    return rows.join(every, "scope", "left").drop("scope")


def load_model(path: str, name: str) -> PipelineModel | None:
    """Load a stored model; None if none of that name is stored (callers fall back).

    Anything else, such as a broken or unreadable model, raises.
    """
    spark = SparkSession.active()
    try:
        spark.read.text(f"{path}/{name}/metadata").schema
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return PipelineModel.load(f"{path}/{name}/model")


def model_summary(spark: SparkSession, path: str) -> DataFrame:
    """Name, type, city, metrics, baseline and feature count of every stored model."""
    return registry(spark, path).select("name", "model_type", "city", F.size("features").alias("n_features"), "metrics", "baseline", "baseline_metrics", "trained_at")
