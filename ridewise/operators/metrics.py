"""Model evaluation as aggregates.

Every metric is a plain aggregate over (label, prediction) rows, so it runs
distributed on the scored test set and is checkable by SQL. AUC is exact:
positives and negatives are counted per distinct score, and the count of
negatives below each score comes from a two-level prefix sum (per range
partition of the scores, then inside it), so no single task ranks all scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewise.functions.columns import col_, round_np
from ridewise.functions.lineage import cut_lineage


# H10 -------------------------------------------------------------------------------
def regression_metrics(df: DataFrame, y: str = "y", pred: str = "pred",
                       by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R², MAPE (%, only y > 0), rounded 3 / 3 / 4 / 2."""
    yv, pv = F.col(y).cast("double"), F.col(pred).cast("double")
    err = yv - pv
    ss_tot = F.var_pop(yv) * F.count(yv)
    g = df.groupBy(*by) if by else df
    return g.agg(
        round_np(F.avg(F.abs(err)), 3).alias("mae"),
        round_np(F.sqrt(F.avg(err * err)), 3).alias("rmse"),
        round_np(F.lit(1.0) - F.sum(err * err) / F.nullif(ss_tot, F.lit(0.0)), 4).alias("r2"),
        round_np(F.avg(F.when(yv > 0, F.abs(err / yv))) * 100, 2).alias("mape"),
        F.count(F.lit(1)).alias("n"),
    )


# H11 / H12 --------------------------------------------------------------------------
def confusion_counts(label: Column, pred: Column) -> list[Column]:
    return [F.count_if((label == 0) & (pred == 0)).alias("tn"),
            F.count_if((label == 0) & (pred == 1)).alias("fp"),
            F.count_if((label == 1) & (pred == 0)).alias("fn"),
            F.count_if((label == 1) & (pred == 1)).alias("tp")]


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """TN FP FN TP and each as % of all rows."""
    cm = df.agg(*confusion_counts(F.col(label).cast("int"), F.col(pred).cast("int")))
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return cm.withColumns({f"{c}_pct": round_np(F.col(c) * 100.0 / n, 2) for c in ("tn", "fp", "fn", "tp")})


def auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC AUC (ties count one half) over any number of rows and scores.

    Distinct scores are range-partitioned by their own distribution and
    stored (at the call: it runs jobs), so scores that crowd together are spread all the same.
    """
    lab, s = F.col(label).cast("int"), F.col(score).cast("double")
    per = df.groupBy(s.alias("s")).agg(F.count_if(lab == 1).alias("pos"), F.count_if(lab == 0).alias("neg"))
    per = cut_lineage(per.repartitionByRange("s").withColumn("b", F.spark_partition_id()), "scores")
    tot = per.groupBy("b").agg(F.sum("neg").alias("bneg"))
    tot = tot.withColumn("neg_before_bucket", F.coalesce(F.sum("bneg").over(
        Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))   # one row a partition
    per = per.join(tot.select("b", "neg_before_bucket"), "b")
    inner = F.coalesce(F.sum("neg").over(Window.partitionBy("b").orderBy("s")
                                         .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = per.withColumn("neg_below", F.col("neg_before_bucket") + inner)
    return per.agg(
        (F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
         / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("auc"))


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "pred",
                           score: str = "score") -> DataFrame:
    """AUC, precision, recall, F1, rounded 4."""
    lab, p = F.col(label).cast("int"), F.col(pred).cast("int")
    cm = df.agg(*confusion_counts(lab, p))
    prec = F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0))
    rec = F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))
    a = auc(df, label, score).scalar()
    return cm.select(
        round_np(a, 4).alias("auc"),
        round_np(F.coalesce(prec, F.lit(0.0)), 4).alias("precision"),
        round_np(F.coalesce(rec, F.lit(0.0)), 4).alias("recall"),
        round_np(F.coalesce(2 * prec * rec / F.nullif(prec + rec, F.lit(0.0)), F.lit(0.0)), 4).alias("f1"))


# H9 / H20 / H2 ----------------------------------------------------------------------
def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(round_np(F.avg(F.col(label).cast("double")), 4).alias("positive_rate"),
                  F.count(F.lit(1)).alias("n"))


def target_stats(df: DataFrame, y: str = "y") -> DataFrame:
    return df.agg(round_np(F.avg(y), 4).alias("mean"), round_np(F.stddev_samp(y), 4).alias("std"))


def scaling_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [round_np(F.avg(x), 6).alias(f"{c}__mean"), round_np(F.stddev_pop(x), 6).alias(f"{c}__std")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"))
            for c in columns]
    return wide.select(F.inline(F.array(*rows)))


# H14 --------------------------------------------------------------------------------
def improvement_over_baseline(model_mae, base_mae) -> Column:
    return round_np((col_(base_mae) - col_(model_mae)) / F.nullif(col_(base_mae), F.lit(0.0)) * 100, 2)


# H16 / H17 --------------------------------------------------------------------------
def equal_width_histogram(df: DataFrame, value: Column, bins: int, by: str | None = None) -> DataFrame:
    """Counts in ``bins`` equal-width bins from min to max (last bin closed),
    per group when ``by`` is given; zero-count bins are kept."""
    keys = [by] if by else ["_g"]
    v = df.select(*([by] if by else [F.lit(0).alias("_g")]), value.cast("double").alias("v")) \
          .where(F.col("v").isNotNull())
    rng = v.groupBy(*keys).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("total"))
    # a zero range is widened by half a unit on each side
    pad = F.when(F.col("hi") == F.col("lo"), F.lit(0.5)).otherwise(F.lit(0.0))
    rng = rng.select(*keys, "total", (F.col("lo") - pad).alias("lo"), (F.col("hi") + pad).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    b = F.least(F.floor((F.col("v") - F.col("lo")) / width).cast("int") + 1, F.lit(bins))
    joined = v.join(F.broadcast(rng), keys, "inner")          # one range row per group
    counts = joined.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = rng.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    out = (grid.join(counts, [*keys, "bin"], "left")
               .select(*keys, "bin", round_np(F.col("lo") + (F.col("bin") - 1) * width, 6).alias("bin_lo"),
                       round_np(F.col("lo") + F.col("bin") * width, 6).alias("bin_hi"),
                       F.coalesce("count", F.lit(0)).cast("long").alias("count"),
                       round_np(F.coalesce("count", F.lit(0)) / (F.col("total") * width), 6).alias("density")))
    return out if by else out.drop("_g")


def residual_histogram(df: DataFrame, y: str = "y", pred: str = "pred", bins: int = 40) -> DataFrame:
    return equal_width_histogram(df, F.col(pred) - F.col(y), bins)


def residual_mean(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    return df.agg(round_np(F.avg(F.col(pred) - F.col(y)), 4).alias("mean_residual"))


def score_histogram_by_class(df: DataFrame, label: str = "label", score: str = "score",
                             bins: int = 40) -> DataFrame:
    return equal_width_histogram(df.withColumn("_cls", F.col(label).cast("int")), F.col(score), bins, by="_cls") \
        .withColumnRenamed("_cls", "label")


# H18 --------------------------------------------------------------------------------
def hourly_actual_vs_pred(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    return df.groupBy("hour").agg(round_np(F.avg(y), 4).alias("actual"), round_np(F.avg(pred), 4).alias("predicted"))
