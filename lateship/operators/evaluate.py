"""Evaluation without collecting predictions: confusion matrix, weighted
metrics and exact AUC are aggregates over the scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from . import stats


def confusion_counts(df: DataFrame, label: str = "late_delivery_risk",
                     prediction: str = "prediction") -> DataFrame:
    """Long confusion matrix (actual, predicted, n); rows are actual classes."""
    return (df.groupBy(F.col(label).cast("double").alias("actual"),
                       F.col(prediction).cast("double").alias("predicted"))
              .agg(F.count(F.lit(1)).alias("n")))


def confusion_square(df: DataFrame, label: str = "late_delivery_risk",
                     prediction: str = "prediction", classes=(0.0, 1.0)) -> DataFrame:
    """Square form: one row per actual class, one column per predicted class,
    and ``pred_other`` for every other prediction (null included), so that a
    row's columns always add up to its class."""
    long = confusion_counts(df, label, prediction)
    known = F.coalesce(F.col("predicted").isin(*classes), F.lit(False))
    return long.groupBy("actual").agg(
        *[F.sum(F.when(F.col("predicted") == c, F.col("n")).otherwise(0)).alias(f"pred_{int(c)}") for c in classes],
        F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("pred_other"))


def classification_metrics(df: DataFrame, label: str = "late_delivery_risk",
                           prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 (beta = 1).

    Classes are the actual labels; a class never predicted has precision 0.
    Everything is derived from the confusion counts (classes^2 rows).
    """
    conf = confusion_counts(df, label, prediction)
    total = Window.partitionBy()
    by_actual = Window.partitionBy("actual")
    by_pred = Window.partitionBy("predicted")
    c = (conf.withColumn("support", F.sum("n").over(by_actual))
             .withColumn("pred_n", F.sum("n").over(by_pred))
             .withColumn("total", F.sum("n").over(total)))
    per_class = (c.groupBy("actual")
                   .agg(F.first("support").alias("support"), F.first("total").alias("total"),
                        F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).alias("tp")))
    pred_n = c.select(F.col("predicted").alias("actual"), "pred_n").distinct()
    m = per_class.join(pred_n, "actual", "left").fillna(0, subset=["pred_n"])
    prec = F.when(F.col("pred_n") > 0, F.col("tp") / F.col("pred_n")).otherwise(0.0)
    rec = F.col("tp") / F.col("support")
    m = m.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    m = m.withColumn("f1", f1).withColumn("wt", F.col("support") / F.col("total"))
    return m.agg(
        (F.sum("tp") / F.first("total")).alias("accuracy"),
        F.sum(F.col("wt") * F.col("precision")).alias("weighted_precision"),
        F.sum(F.col("wt") * F.col("recall")).alias("weighted_recall"),
        F.sum(F.col("wt") * F.col("f1")).alias("weighted_f1"),
    )


def auc_roc_exact(df: DataFrame, label: str = "late_delivery_risk",
                  score: str = "score") -> DataFrame:
    return stats.auc_exact(df, label, score)
