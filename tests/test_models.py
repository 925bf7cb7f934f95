"""MLlib jobs: ridge equals the closed-form solution; model jobs run end to end."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridewise.operators import models as ML
from ridewise.operators import scoring as J
from ridewise.plans import catalog as C
from ridewise.plans import stages as S
from ridewise.plans import training as T
from ridewise.sources import writers as WR

SMALL = "/root/testdata/sf0.001"


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(7)
    n, k = 200, 3
    X = rng.normal(size=(n, k)) * [1.0, 3.0, 0.5] + [2.0, -1.0, 0.0]
    y = X @ [1.5, -0.7, 2.0] + rng.normal(scale=0.3, size=n) + 4.0
    rows = [tuple(map(float, r)) + (float(t),) for r, t in zip(X, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    got = ML.ridge_baseline(df, df, ["a", "b", "c"], "y", alpha=1.0, lo=None).select("pred").toPandas()["pred"]
    # sklearn-style: standardise with population std, ridge α = 1, unpenalised intercept
    Z = (X - X.mean(0)) / X.std(0)
    w = np.linalg.solve(Z.T @ Z + np.eye(k), Z.T @ (y - y.mean()))
    want = Z @ w + y.mean()
    assert np.allclose(np.sort(got.to_numpy()), np.sort(want), atol=1e-6)


@pytest.fixture(scope="module")
def few(spark, tmp_path_factory):
    """All training jobs with few trees, and the folder they store into."""
    path = str(tmp_path_factory.mktemp("models"))
    jobs = T.model_jobs(spark, S.enriched(spark, SMALL), T.ride_split(S.enriched(spark, SMALL)), path, trees=2, cancel_trees=2)
    return {name: job() for name, job in jobs.items()}, path


def test_registry_answers_from_stored_files_alone(spark, few, monkeypatch):
    done, path = few
    fresh = spark.newSession()                                  # knows nothing of the training session
    rows = ML.model_summary(fresh, path).collect()
    assert {r["name"] for r in rows if r.city is None} == {"wait_time", "surge", "cancellation"}
    assert {r.city for r in rows if r.city} == set(done["demand"][1])
    assert set(done) == {"wait", "surge", "cancellation", "demand"}
    assert all(r.baseline_metrics for r in rows if r.name != "cancellation")
    # no training where every model has an entry
    monkeypatch.setattr(S, "model_path", lambda *_: path)
    monkeypatch.setattr(T, "model_jobs", lambda *_: pytest.fail("trained again"))
    board = {(r.scope, r.model): r for r in C.q_leaderboard(spark, SMALL).collect()}
    wait = {r["model"]: r for r in done["wait"][0].collect()}
    assert board["wait_time", "gbt"].mae == wait["gbt"].mae and board["wait_time", "ridge"].mae == wait["ridge"].mae
    assert board["wait_time", "gbt"].gain_pct == pytest.approx((wait["ridge"].mae - wait["gbt"].mae) / wait["ridge"].mae * 100, abs=0.006)
    assert {s for s, _ in board} == set(done["demand"][1]) | {"average", "wait_time"}
    top = C.q_importances(spark, SMALL).toPandas()
    assert set(top.name) == {r["name"] for r in rows}
    assert (top.groupby("name").importance.sum().round(6) == 1).all()
    assert [r.asDict() for r in C.q_wait_model(spark, SMALL).orderBy("model").collect()] == [r.asDict() for r in done["wait"][0].orderBy("model").collect()]


def test_registry_takes_fold_figures_where_stored(spark, few, monkeypatch):
    _, path = few
    monkeypatch.setattr(S, "model_path", lambda *_: path)
    before = {r.name: r for r in C.q_model_registry(spark, SMALL).collect()}
    assert all(r.cv_mean is None for r in before.values()) and before["surge"].metric == "auc" and before["wait_time"].baseline_value > 0
    ML.store_folds(spark.createDataFrame([("all", 1, 2.0, 0.5), ("all", 2, 2.0, 0.5)], "scope string, fold int, mean_mae double, std_mae double"), path, "wait_time")
    ML.store_folds(spark.createDataFrame([("Mumbai", 1, 3.0, 0.1)], "scope string, fold int, mean_mae double, std_mae double"), path, "demand")
    after = {r.name: r for r in C.q_model_registry(spark, SMALL).collect()}
    assert after.keys() == before.keys() and (after["wait_time"].cv_mean, after["wait_time"].cv_std) == (2.0, 0.5)
    assert after["demand_Mumbai"].cv_mean == 3.0 and after["demand_Chennai"].cv_mean is None
    assert C.q_cv_wait(spark, SMALL).count() == 2                # the stored folds, not computed again


def test_requests_are_scored_by_their_citys_model(spark, few):
    done, _ = few
    models = done["demand"][1]
    asked = J.scenarios_from_rides(S.enriched(spark, SMALL)).withColumn("rides_lag_1d", F.when(F.col("hour") > 12, 40.0))
    got = J.predict_demand(asked, models)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    got = {r.scenario_id: r for r in got.collect()}
    assert len(got) == asked.count() and min(r.predicted_rides for r in got.values()) >= 0
    for city, model in models.items():
        for r in ML.score_regression(model, J.build_scenario_features(asked.where(F.col("city") == city)), lo=0.0).collect():
            assert got[r.scenario_id].predicted_rides == pytest.approx(r.pred)
    assert J.predict_demand(asked.limit(3).withColumn("city", F.lit("Nowhere")), models).where("predicted_rides is not null").count() == 0


def test_class_weight_acts_like_copies(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 8, (400, 2)).astype(float)
    y = (x[:, 0] + rng.normal(size=400) > 7).astype(int)
    rows = [(*map(float, v), int(t), i) for i, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "a double, b double, y int, id int").coalesce(1)
    weighted = T.class_weighted(df, "y")
    p = y.mean()
    assert {round(r.class_weight, 9) for r in weighted.where("y = 1").collect()} == {round((1 - p) / p, 9)}
    whole = weighted.withColumn("class_weight", F.when(F.col("y") == 1, 4.0).otherwise(1.0))
    copies = df.withColumn("k", F.explode(F.when(F.col("y") == 1, F.sequence(F.lit(1), F.lit(4))).otherwise(F.array(F.lit(1)))))

    def scores(data, **kw):
        model = ML.fit(data, ["a", "b"], ML.gbt_classifier("y", max_iter=3, max_depth=2, subsample=1.0, min_leaf=1, **kw))
        return [r.score for r in ML.score_classifier(model, df).orderBy("id").collect()]

    assert np.allclose(scores(whole, weight_col="class_weight"), scores(copies), atol=1e-6)
    assert not np.allclose(scores(whole, weight_col="class_weight"), scores(df), atol=1e-3)


def test_catalog_table_is_replaced(spark):
    feat = S.enriched(spark, SMALL)
    name = S.table_name(spark, SMALL, "replaced")
    assert WR.write_clean_table(feat, name) == feat.count()
    assert WR.write_clean_table(feat.where("city = 'Mumbai'"), name) == feat.where("city = 'Mumbai'").count()
    assert [r.city for r in spark.table(name).select("city").distinct().collect()] == ["Mumbai"]
    spark.sql(f"DROP TABLE {name}")


def test_load_model_is_none_only_when_absent(spark, tmp_path):
    assert ML.load_model(str(tmp_path), "nothing") is None
    (tmp_path / "broken" / "metadata").mkdir(parents=True)
    (tmp_path / "broken" / "metadata" / "part.txt").write_text("{}")
    with pytest.raises(Exception):
        ML.load_model(str(tmp_path), "broken")


def test_iterations_are_the_references():
    import inspect

    for f, n in ((T.train_wait, 200), (T.train_demand, 200), (T.train_classifier, 200)):
        assert inspect.signature(f).parameters["max_iter"].default == n
    assert inspect.signature(T.model_jobs).parameters["cancel_trees"].default == 150


def test_logistic_matches_newton_solution(spark):
    rng = np.random.default_rng(11)
    n, k = 300, 3
    X = rng.normal(size=(n, k)) * [1.0, 2.0, 0.5]
    logit = X @ [1.0, -0.5, 2.0] - 0.3
    y = (rng.random(n) < 1 / (1 + np.exp(-logit))).astype(int)
    rows = [tuple(map(float, r)) + (int(t),) for r, t in zip(X, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int")
    got = ML.logistic_baseline(df, df, ["a", "b", "c"], "y").select("a", "score").toPandas()
    # C = 1: minimise 0.5·|w|² + Σ logloss on population-std-scaled features, intercept free
    Z = np.c_[(X - X.mean(0)) / X.std(0), np.ones(n)]
    w = np.zeros(k + 1)
    reg = np.diag([1.0] * k + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-Z @ w))
        g = Z.T @ (p - y) + reg @ w
        H = Z.T @ (Z * (p * (1 - p))[:, None]) + reg
        w -= np.linalg.solve(H, g)
    want = 1 / (1 + np.exp(-Z @ w))
    order = np.argsort(X[:, 0])
    got_sorted = got.sort_values("a")["score"].to_numpy()
    assert np.allclose(got_sorted, want[order], atol=1e-3)


def test_training_sets_are_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(ML, "FIT_ROWS", 100)
    monkeypatch.setattr(ML, "FULL_ROWS", 1000)
    cores = spark.sparkContext.defaultParallelism
    n = 100 * cores * 20 + 1                                    # more full partitions than cores, and a few rows too many for one each

    def sizes(rows):
        found = ML._dealt(rows, n).groupBy(F.spark_partition_id()).count().collect()
        return sorted(r["count"] for r in found)

    # the rows of most partitions are filtered out, as those of test days are
    uneven = spark.range(0, 4 * n, 1, 4 * cores).where(F.col("id") < n)
    got = sizes(uneven)
    assert len(got) == cores * 3 and sum(got) == n
    assert got[-1] - got[0] <= 4 * cores
    assert ML._dealt(spark.range(0, 250, 1, 8), 250).rdd.getNumPartitions() == min(3, cores)


def test_a_request_is_scored_by_its_own_citys_trees(spark):
    """F16: the cities' predictions stand inside the branches that pick them, not in a projection that computes them all."""
    from ridewise.operators.timeseries import DEMAND_FEATURES
    rows = spark.createDataFrame([tuple(float((i + j) % 5) for j in range(len(DEMAND_FEATURES) + 1)) for i in range(60)], [*DEMAND_FEATURES, "rides"])
    models = {c: ML.fit(rows.withColumn("rides", F.col("rides") + k), DEMAND_FEATURES, ML.gbt_regressor("rides", max_iter=2, min_leaf=2))
              for k, c in enumerate(("Delhi", "Mumbai", "Pune"))}
    asked = spark.createDataFrame([(c, h, 2, 6, "fog", False, True) for c in (*models, "Nowhere", None) for h in (3, 9)],
                                  "city string, hour int, day_of_week int, month int, weather string, is_festival boolean, is_ipl_day boolean")
    got = J.predict_demand(asked, models)
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = got._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "_rides_" not in plan and plan.count("UDF(") >= len(models)
    value = {(r.city, r.hour): r.predicted_rides for r in got.collect()}
    assert all((value[c, h] is None) == (c not in models) for c, h in value) and len(value) == 10
    for c, m in models.items():
        own = m.transform(J.build_scenario_features(asked.where(F.col("city") == c))).select("hour", "pred").collect()
        assert all(value[c, r.hour] == max(r.pred, 0.0) for r in own)
