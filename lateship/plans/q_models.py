"""Model queries.

A fit has no SQL form, but its split, its row counts and the relations that
must hold among its results have: each query returns what SQL can say about
all its rows, next to flags that are worked out from the predictions. Fitted
models are memoized per session and data folder, so that the scoring and
reporting queries reuse one fit.
"""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, functions as F

from ..ml import train as T
from ..ml.moments import fold_statistics, merged
from ..operators.clean import hash_bucket, split_hash
from ..operators.evaluate import classification_metrics
from ..schema import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES
from ..session import shared_dir
from .oracle import with_fixtures
from .q_features import _bucket_sql, _present, model_input
from .registry import query

_KEYS = ["order_id", "line_no"]
_FITS: dict = {}
_TEST = f"{_bucket_sql('42', 10)} >= 8"
_TRAIN = f"{_bucket_sql('42', 10)} < 8"
LR = "Logistic Regression"
#: The grid that shows the choice among several points.
SEARCH = {"regParam": [0.001, 0.01, 0.3], "elasticNetParam": [0.0]}


def fitted(spark, sf_dir, name, grid=None):
    key = (spark.sparkContext.applicationId, sf_dir, name, str(grid))
    if key not in _FITS:
        _FITS[key] = T.train_and_select(model_input(spark, sf_dir), name, _KEYS, grid=grid)
    return _FITS[key]


def _report(spark, sf_dir, name) -> DataFrame:
    """The evaluation report next to what can be recomputed from the scored rows."""
    r = fitted(spark, sf_dir, name)
    scored = T.score(r.model, r.test)
    report = T.evaluation_report(scored, name)
    recount = scored.agg(F.count(F.lit(1)).alias("test_rows"), F.sum(F.col(LABEL)).cast("long").alias("test_late"),
                         F.avg((F.col("prediction") == F.col(LABEL)).cast("double")).alias("hits")).first()
    return (report.select("model", F.lit(recount["test_rows"]).cast("long").alias("test_rows"),
                    F.lit(recount["test_late"]).cast("long").alias("test_late"),
                    (F.abs(F.col("accuracy") - F.lit(recount["hits"])) < 1e-9).alias("accuracy_agrees"),
                    (F.abs(F.col("weighted_recall") - F.col("accuracy")) < 1e-9).alias("recall_is_accuracy"),
                    (F.abs(F.col("auc") - F.col("auc_exact")) < 0.01).alias("auc_agrees"),
                    (F.col("auc_exact") > 0.5).alias("better_than_chance")))


def _report_sql(name):
    return with_fixtures(f"""
SELECT '{name}' AS model, count(*) AS test_rows, CAST(sum({LABEL}) AS BIGINT) AS test_late,
       true AS accuracy_agrees, true AS recall_is_accuracy, true AS auc_agrees, true AS better_than_chance
FROM model_input WHERE {_TEST}""", "model_input")


@query("train_logistic_regression", _report_sql(LR))
def train_logistic_regression(spark, sf_dir):
    return _report(spark, sf_dir, LR)


@query("train_random_forest", _report_sql("Random Forest"))
def train_random_forest(spark, sf_dir):
    return _report(spark, sf_dir, "Random Forest")


@query("train_gbt", _report_sql("Gradient-Boosted Trees (GBT)"))
def train_gbt(spark, sf_dir):
    return _report(spark, sf_dir, "Gradient-Boosted Trees (GBT)")


@query("cross_validate_grid", with_fixtures(f"""
SELECT '{LR}' AS model, params, train_rows, true AS auc_in_range, true AS best_is_chosen
FROM (SELECT count(*) AS train_rows FROM model_input WHERE {_TRAIN}),
     (VALUES {", ".join(f"('elasticNetParam=0.0, regParam={r}')" for r in SEARCH["regParam"])}) g(params)""", "model_input"))
def cross_validate_grid(spark, sf_dir):
    """Every grid point once; the fitted model is that of the highest mean AUC."""
    r = fitted(spark, sf_dir, LR, SEARCH)
    rows = r.train.count()
    chosen = r.model.stages[-1].getOrDefault("regParam")
    points = r.grid_metrics
    top = points.agg(F.max("avg_auc")).first()[0]  # one number
    is_chosen = F.col("params").endswith(f"regParam={chosen}")
    return points.select("model", "params", F.lit(rows).cast("long").alias("train_rows"),
                         ((F.col("avg_auc") > 0.5) & (F.col("avg_auc") <= 1.0)).alias("auc_in_range"),
                         (~is_chosen | (F.col("avg_auc") == F.lit(top))).alias("best_is_chosen"))


@query("score_batch", with_fixtures(f"""
SELECT order_id, line_no, late_delivery_risk, true AS follows_probability FROM model_input WHERE {_TEST}""", "model_input"))
def score_batch(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    r = fitted(spark, sf_dir, LR)
    p = vector_to_array("probability")
    return T.score(r.model, r.test).select(
        *_KEYS, LABEL, ((F.col("prediction") == (p[1] > 0.5).cast("double")) & (F.abs(p[0] + p[1] - 1) < 1e-9)).alias("follows_probability"))


_WIDTH = " + ".join([str(len(NUMERIC_FEATURES)), *[f"(SELECT count(DISTINCT {c}) FROM model_input WHERE {_TRAIN})" for c in CATEGORICAL_FEATURES]])


@query("prediction_view", with_fixtures(f"""
SELECT late_delivery_risk, count(*) AS n, CAST({_WIDTH} AS BIGINT) AS features, true AS consistent
FROM model_input WHERE {_TEST} GROUP BY late_delivery_risk""", "model_input"))
def prediction_view(spark, sf_dir):
    """Per label: rows of the view, length of its feature text, and whether
    each probability and prediction fit together."""
    r = fitted(spark, sf_dir, LR)
    v = T.prediction_view(T.score(r.model, r.test))
    prob, late = F.col("prob_late"), F.col("prediction") == 1.0
    ok = prob.between(0.0, 1.0) & F.when(late, prob >= 0.5).otherwise(prob <= 0.5)
    width = F.size(F.split(F.col("features_str"), ","))
    return v.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"), F.max(width).cast("long").alias("features"),
                                (F.every(ok) & (F.min(width) == F.max(width))).alias("consistent"))


@query("evaluate_model", with_fixtures("""
SELECT count(*) AS rows, CAST(sum(late_delivery_risk) AS BIGINT) AS late, true AS accuracy, true AS weighted_precision,
       true AS weighted_recall, true AS weighted_f1 FROM model_input""", "model_input"))
def evaluate_model(spark, sf_dir):
    """The reloaded model over all rows: our metrics against MLlib's evaluator."""
    r = fitted(spark, sf_dir, LR)
    model = T.load_model(T.save_model(r.model, shared_dir(spark, "evaluate-model"), r.name))
    with T.persisted(T.score(model, model_input(spark, sf_dir)).select(LABEL, "prediction")) as scored:
        ours = classification_metrics(scored, LABEL, "prediction").first().asDict()
        counts = scored.agg(F.count(F.lit(1)).alias("rows"), F.sum(LABEL).cast("long").alias("late")).first()
        mllib = {ours_name: MulticlassClassificationEvaluator(labelCol=LABEL, metricName=name).evaluate(scored)
                 for ours_name, name in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                                         ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1"))}
    row = (counts["rows"], counts["late"], *[abs(ours[k] - v) < 1e-9 for k, v in mllib.items()])
    return spark.createDataFrame([row], "rows long, late long, " + ", ".join(f"{k} boolean" for k in mllib))


@query("model_save_load_score", with_fixtures(f"""
SELECT order_id, line_no, true AS same FROM model_input WHERE {_TEST}""", "model_input"))
def model_save_load_score(spark, sf_dir):
    """Save the best pipeline, load it back, score the test part with both
    and report agreement per row (``same`` must be true everywhere)."""
    r = fitted(spark, sf_dir, LR)
    path = T.save_model(r.model, shared_dir(spark, "models"), r.name)
    loaded = T.load_model(path)
    saved = T.score(r.model, r.test).select(*r.test.columns, F.col("probability").alias("p_saved"))
    return T.score(loaded, saved).select(*_KEYS, (F.col("p_saved") == F.col("probability")).alias("same"))


# --- feature statistics by fold, and what was fitted from them -------------------

_FOLD = _bucket_sql("fold", 2)


def _fold_rows(spark, sf_dir):
    train, _ = split_hash(model_input(spark, sf_dir), _KEYS)
    return train.withColumn("fold", hash_bucket(_KEYS, 2, "fold"))


def _moments_sql(c: str, where: str) -> str:
    """Present values, and moments after missing values became the mean."""
    present = f"FILTER (WHERE {_present(c)})"
    return f"""
SELECT '{c}' AS column_name, count(*) {present} AS present, avg({c}) {present} AS mean,
       sqrt(var_pop({c}) {present} * count(*) {present} / (count(*) - 1)) AS std
FROM model_input WHERE {where}"""


@query("fold_moments", with_fixtures("\nUNION ALL\n".join(
    f"SELECT {k} AS without_fold, column_name, present, round(mean, 6) AS mean, round(std, 6) AS std "
    f"FROM ({_moments_sql(c, _TRAIN + f' AND {_FOLD} <> {k}')})" for k in (-1, 0, 1) for c in NUMERIC_FEATURES), "model_input"))
def fold_moments(spark, sf_dir):
    """Moments of the imputed features for the training part and for each
    fold left out, all from one aggregate by fold."""
    s = fold_statistics(_fold_rows(spark, sf_dir), NUMERIC_FEATURES, [])
    rows = []
    for k in (-1, 0, 1):
        m = merged(s, without=k)
        rows += [(k, c, m.moments[c].n, *(round(x, 6) for x in m.imputed(c))) for c in NUMERIC_FEATURES]
    return spark.createDataFrame(rows, "without_fold int, column_name string, present long, mean double, std double")


@query("fold_labels", with_fixtures("\nUNION ALL\n".join(f"""
SELECT {k} AS without_fold, '{c}' AS column_name, value, cnt AS "count", CAST(row_number() OVER (ORDER BY cnt DESC, value) - 1 AS INTEGER) AS "index"
FROM (SELECT {c} AS value, count(*) AS cnt FROM model_input WHERE {_TRAIN} AND {_FOLD} <> {k} AND {c} IS NOT NULL GROUP BY 1)"""
    for k in (-1, 0, 1) for c in CATEGORICAL_FEATURES), "model_input"))
def fold_labels(spark, sf_dir):
    """Label order for the training part and for each fold left out."""
    s = fold_statistics(_fold_rows(spark, sf_dir), [], CATEGORICAL_FEATURES)
    rows = []
    for k in (-1, 0, 1):
        m = merged(s, without=k)
        rows += [(k, c, v, m.labels[c][v], i) for c in CATEGORICAL_FEATURES for i, v in enumerate(m.ordered_labels(c))]
    return spark.createDataFrame(rows, "without_fold int, column_name string, value string, count long, index int")


def _feature_sql(select: str) -> str:
    """Features of the training part in vector order."""
    labels = "\nUNION ALL\n".join(f"""
SELECT {i} AS block, '{c}' AS column_name, value, row_number() OVER (ORDER BY cnt DESC, value) AS nth, cnt / n AS mean,
       sqrt(cnt * (n - cnt) / (n * (n - 1))) AS std
FROM (SELECT {c} AS value, CAST(count(*) AS DOUBLE) AS cnt FROM train WHERE {c} IS NOT NULL GROUP BY 1), (SELECT CAST(count(*) AS DOUBLE) AS n FROM train)"""
        for i, c in enumerate(CATEGORICAL_FEATURES, 1))
    numbers = "\nUNION ALL\n".join(f"""
SELECT 0 AS block, column_name, NULL AS value, {i} AS nth, mean, std FROM ({_moments_sql(c, _TRAIN)})"""
        for i, c in enumerate(NUMERIC_FEATURES))
    return with_fixtures(select, "model_input", extra=f"""
train AS (SELECT * FROM model_input WHERE {_TRAIN}),
parts AS ({numbers} UNION ALL {labels}),
features AS (SELECT CAST(row_number() OVER (ORDER BY block, nth) - 1 AS INTEGER) AS position, * FROM parts)""")


def _feature_names(r) -> list[tuple]:
    """(column, label or None) of each position of the fitted vector."""
    index = [s for s in r.model.stages if hasattr(s, "labelsArray")]
    return [(c, None) for c in NUMERIC_FEATURES] + [(c, v) for c, s in zip(CATEGORICAL_FEATURES, index) for v in s.labels]


@query("trained_feature_stages", _feature_sql(
    "SELECT position, column_name, value, round(mean, 6) AS mean, round(std, 6) AS std FROM features"))
def trained_feature_stages(spark, sf_dir):
    """Label order, means and deviations in the stages of the trained
    pipeline, which come from fold statistics, next to SQL over the rows."""
    r = fitted(spark, sf_dir, LR)
    scaler = r.model.stages[-2]
    rows = [(i, c, v, round(float(m), 6), round(float(d), 6))
            for i, ((c, v), m, d) in enumerate(zip(_feature_names(r), scaler.mean.toArray(), scaler.std.toArray()))]
    return spark.createDataFrame(rows, "position int, column_name string, value string, mean double, std double")


@query("logistic_gradient", _feature_sql("SELECT position, column_name, value, true AS stationary FROM features"))
def logistic_gradient(spark, sf_dir):
    """Whether the regularised log-loss is stationary at the returned
    coefficients: the gradient over all training rows, feature by feature, for
    the stated regularisation. A wrong parameter, a dropped feature or wrong
    moments would move it."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer
    r = fitted(spark, sf_dir, LR)
    w, reg = r.model.stages[-1].coefficients.toArray(), 0.01
    miss = vector_to_array("probability")[1] - F.col(LABEL)
    x = T.score(r.model, r.train).select("features_scaled", miss.alias("miss"))
    part = lambda sign: F.greatest(F.col("miss") * sign, F.lit(0.0))  # noqa: E731  weights may not be negative
    mean = lambda sign: Summarizer.mean(F.col("features_scaled"), part(sign))
    s = x.select(mean(1).alias("over"), mean(-1).alias("under"), F.sum(part(1)).alias("o"), F.sum(part(-1)).alias("u"),
                 F.count(F.lit(1)).alias("n")).first()  # two vectors
    g = (s["over"].toArray() * s["o"] - s["under"].toArray() * s["u"]) / s["n"] + reg * w
    rows = [(i, c, v, bool(abs(d) < 1e-4)) for i, ((c, v), d) in enumerate(zip(_feature_names(r), g))]
    return spark.createDataFrame(rows, "position int, column_name string, value string, stationary boolean")
