"""Evaluation queries on the fixed-score table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, stats
from ..sources.fixtures import predictions
from .oracle import with_fixtures
from .registry import query


@query("score_fixed_logit", with_fixtures("SELECT * FROM predictions", "predictions"))
def score_fixed_logit(spark, sf_dir):
    return predictions(spark, sf_dir)


@query("confusion_matrix", with_fixtures("""
SELECT CAST(late_delivery_risk AS DOUBLE) AS actual, prediction AS predicted, count(*) AS n
FROM predictions GROUP BY ALL""", "predictions"))
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_counts(predictions(spark, sf_dir))


@query("confusion_matrix_square", with_fixtures("""
SELECT CAST(late_delivery_risk AS DOUBLE) AS actual,
       count(*) FILTER (WHERE prediction = 0.0) AS pred_0,
       count(*) FILTER (WHERE prediction = 1.0) AS pred_1,
       count(*) FILTER (WHERE prediction IS NULL OR prediction NOT IN (0.0, 1.0)) AS pred_other
FROM predictions GROUP BY ALL""", "predictions"))
def confusion_matrix_square(spark, sf_dir):
    return evaluate.confusion_square(predictions(spark, sf_dir))


_METRICS_CTES = """
conf AS (SELECT CAST(late_delivery_risk AS DOUBLE) AS actual, prediction AS predicted, count(*) AS n
         FROM predictions GROUP BY ALL),
cls AS (SELECT a.actual,
               sum(n) AS support,
               sum(n) FILTER (WHERE actual = predicted) AS tp,
               (SELECT coalesce(sum(n), 0) FROM conf c2 WHERE c2.predicted = a.actual) AS pred_n
        FROM conf a GROUP BY a.actual),
m AS (SELECT *, CASE WHEN pred_n > 0 THEN tp / pred_n ELSE 0.0 END AS precision,
             tp / support AS recall, support / (SELECT sum(n) FROM conf) AS wt FROM cls)"""
_METRICS = """
SELECT round(sum(tp) / (SELECT sum(n) FROM conf), 9) AS accuracy,
       round(sum(wt * precision), 9) AS weighted_precision,
       round(sum(wt * recall), 9) AS weighted_recall,
       round(sum(wt * CASE WHEN precision + recall > 0
                           THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END), 9) AS weighted_f1
FROM m"""


@query("classification_metrics", with_fixtures(_METRICS, "predictions", extra=_METRICS_CTES))
def classification_metrics(spark, sf_dir):
    m = evaluate.classification_metrics(predictions(spark, sf_dir))
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


_AUC_CTES = """
g AS (SELECT score AS s, sum(CASE WHEN late_delivery_risk = 1 THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN late_delivery_risk = 1 THEN 0 ELSE 1 END) AS neg
      FROM predictions WHERE score IS NOT NULL AND late_delivery_risk IS NOT NULL GROUP BY score),
c AS (SELECT *, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_le FROM g)"""


@query("auc_roc_exact", with_fixtures("""
SELECT round(sum(pos * (neg_le - neg + neg / 2.0)) / (sum(pos) * sum(neg)), 9) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c""",
    "predictions", extra=_AUC_CTES))
def auc_roc_exact(spark, sf_dir):
    a = evaluate.auc_roc_exact(predictions(spark, sf_dir))
    return a.select(F.round("auc", 9).alias("auc"), "n_pos", "n_neg")


_HIST = """
h AS (SELECT days_scheduled % 3 AS part, CAST(floor(least(greatest(score, 0.0), 1.0) * 40) AS INTEGER) AS bin,
             CAST(sum(CASE WHEN p.late_delivery_risk = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
             CAST(sum(CASE WHEN p.late_delivery_risk = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg
      FROM predictions p JOIN order_items USING (order_id, line_no) GROUP BY 1, 2),
b AS (SELECT bin, sum(pos) AS pos, sum(neg) AS neg FROM h GROUP BY bin),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM b)"""


@query("auc_histogram", with_fixtures("""
SELECT round((sum(pos * below) + sum(pos * neg) / 2.0) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 9) AS auc,
       round(sum(pos * neg) / 2.0 / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 9) AS error,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg, true AS within FROM c""",
    "predictions", "order_items", extra=_HIST))
def auc_histogram(spark, sf_dir):
    """Score histograms of three parts of the table, merged: the area under
    ROC with its error bound, and whether the exact area lies within."""
    from ..sources.fixtures import order_items
    days = order_items(spark, sf_dir).select("order_id", "line_no", (F.col("days_scheduled") % 3).alias("part"))
    p = predictions(spark, sf_dir).join(days, ["order_id", "line_no"])
    merged = stats.auc_bounds(stats.score_histogram(p, "late_delivery_risk", "score", bins=40, by=["part"]))
    exact = stats.auc_exact(p, "late_delivery_risk", "score").first()["auc"]  # one number
    within = F.abs(F.col("auc") - F.lit(exact)) <= F.col("error") + 1e-12
    return merged.select(F.round("auc", 9).alias("auc"), F.round("error", 9).alias("error"), "n_pos", "n_neg", within.alias("within"))
