"""Feature stages from fold statistics equal stages fitted on the rows."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lateship.ml import train as T
from lateship.ml.moments import Moments, fitted_stages, fold_statistics, merged
from lateship.ml.stages import feature_stages

NUM, CAT = ["x", "big", "const"], ["c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(1)
    out = []
    for i in range(900):
        x = None if i % 11 == 0 else float("nan") if i % 13 == 0 else rnd.gauss(0, 1)
        c = rnd.choice(["a", "b", "é", "Z", None]) if i % 3 else "a"
        d = "only" if i % 3 == 0 else rnd.choice(["p", "q"])
        y = int(rnd.random() < 1 / (1 + math.exp(-(x or 0) if x == x else 0)))
        out.append((i, x, 1e9 + rnd.gauss(0, 1), 5.0, c, d, i % 3, y))
    return spark.createDataFrame(out, "id long, x double, big double, const double, c string, d string, fold int, y int").repartition(5)


@pytest.mark.parametrize("without", [None, 0, 1, 2])
def test_stages_equal_those_fitted_on_the_rows(spark, rows, without):
    part = rows if without is None else rows.where(F.col("fold") != without)
    mine = PipelineModel(stages=fitted_stages(spark, merged(fold_statistics(rows, NUM, CAT), without), NUM, CAT))
    theirs = Pipeline(stages=feature_stages(NUM, CAT)).fit(part)
    assert [tuple(s.labels) for s in mine.stages[1:3]] == [tuple(x) for x in theirs.stages[1].labelsArray]
    assert mine.stages[3].categorySizes == theirs.stages[2].categorySizes
    read = lambda m: np.array([r.v for r in m.transform(rows).orderBy("id").select(vector_to_array("features").alias("v")).collect()])
    a, b = read(mine), read(theirs)
    assert a.shape == b.shape
    big = NUM.index("big")  # 1e9 +- 1: seven digits are left of the deviations
    rest = [i for i in range(a.shape[1]) if i != big]
    assert np.abs(a[:, rest] - b[:, rest]).max() < 1e-9
    assert np.abs(a[:, big] - b[:, big]).max() < 1e-5


def test_saved_stages_load(spark, rows, tmp_path):
    m = PipelineModel(stages=fitted_stages(spark, merged(fold_statistics(rows, NUM, CAT)), NUM, CAT))
    m.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    same = back.transform(m.transform(rows).select("id", *NUM, *CAT, F.col("features").alias("f"))).where("features = f").count()
    assert same == rows.count()


def test_moments_merge():
    rnd = np.random.default_rng(2)
    v = rnd.normal(1e8, 1, 1000)
    parts = [Moments(len(p), p.mean(), ((p - p.mean()) ** 2).sum()) for p in (v[:1], v[1:300], v[300:300], v[300:]) if len(p)] + [Moments()]
    total = sum(parts[1:], parts[0])
    assert total.n == 1000 and abs(total.mean - v.mean()) < 1e-6 and abs(total.m2 / ((v - v.mean()) ** 2).sum() - 1) < 1e-6


def test_no_values_to_impute_from(spark):
    df = spark.createDataFrame([(None, 0)], "x double, fold int")
    with pytest.raises(ValueError, match="no value"):
        fitted_stages(spark, merged(fold_statistics(df, ["x"], [])), ["x"], [])
    with pytest.raises(ValueError, match="no rows"):
        merged({})


def test_sparse_fit_equals_the_centred_fit(spark, rows):
    """Coefficients, intercept (means folded in) and probabilities."""
    cols = ["x", "const"]
    r = T.train_and_select(rows, "Logistic Regression", ["id"], cols, CAT, label="y")
    w, b = T.centred_coefficients(r)
    dense = PipelineModel(stages=fitted_stages(spark, r.statistics, cols, CAT)).transform(r.train)
    ref = LogisticRegression(featuresCol="features", labelCol="y", regParam=0.01, tol=1e-9).fit(dense)
    assert np.abs(np.array(w) - ref.coefficients.toArray()).max() < 1e-4 and abs(b - ref.intercept) < 1e-4
    assert dense.schema["features"].dataType == dense.schema["features_scaled"].dataType
    scored = T.score(r.model, r.test)
    x = scored.withColumn("m", vector_to_array("features")).select("m", vector_to_array("probability")[1].alias("p")).collect()
    for row in x[:50]:
        assert abs(row.p - 1 / (1 + math.exp(-(np.dot(w, row.m) + b)))) < 1e-9
    auc = T.BinaryClassificationEvaluator(labelCol="y")
    assert abs(auc.evaluate(ref.transform(scored.select("features", "y"))) - auc.evaluate(scored)) < 1e-3
    r.release()


def test_first_trees_of_a_longer_boosting(spark, rows):
    df = PipelineModel(stages=fitted_stages(spark, merged(fold_statistics(rows, NUM, CAT)), NUM, CAT)).transform(rows).select("id", "features", "y").cache()
    fit = lambda n: GBTClassifier(labelCol="y", maxIter=n, maxDepth=2, seed=5).fit(df)
    long, short = fit(6), fit(3)
    first = T.boosting_prefix(long, 3)
    assert first.getNumTrees == 3
    p = lambda m: [tuple(r.probability) for r in m.transform(df).orderBy("id").select("probability").collect()]
    assert p(first) == p(short) != p(long)


def test_only_the_longest_boosting_is_fitted():
    est, grid = T.classifier_and_grid("Gradient-Boosted Trees (GBT)")
    fits = T._fits(est, grid)
    assert len(grid) == 4 and len(fits) == 2
    assert sorted(i for _, points in fits for i, _ in points) == [0, 1, 2, 3]
    assert all(p[est.maxIter] == 50 for p, _ in fits) and all(t == grid[i][est.maxIter] for _, points in fits for i, t in points)
    est, grid = T.classifier_and_grid("Logistic Regression", grid={"regParam": [0.1, 0.2]})
    assert [points for _, points in T._fits(est, grid)] == [[(0, None)], [(1, None)]]


@pytest.mark.parametrize("reg", [0.001, 0.3])
def test_newton_fit_equals_the_fit_on_vectors(spark, rows, reg):
    """Coefficients, intercept and cross-validated area of MLlib's fits on
    prepared vectors, with missing numbers and labels and a label that only
    one fold holds; no vectors are prepared for the fit."""
    odd = F.when((F.col("fold") == 0) & (F.col("id") % 50 == 0), "rare").otherwise(F.col("c"))
    train = rows.withColumn("c", odd).cache()
    cols, stats = ["x", "const"], fold_statistics(train, ["x", "const"], CAT)
    est, grid = T.classifier_and_grid("Logistic Regression", "y", grid={"regParam": [reg]}, features="features_scaled")
    assert T.applies(est, grid, CAT, cols, merged(stats))
    metrics, fits, layout = T.newton_search(train, stats, cols, CAT, est, grid, 3, "y")
    mine = T.fitted_model(spark, est, grid[0], fits[0], layout)
    ref = LogisticRegression(featuresCol="features_scaled", labelCol="y", regParam=reg, tol=1e-10)
    theirs = ref.fit(PipelineModel(stages=fitted_stages(spark, merged(stats), cols, CAT)).transform(train))
    assert np.abs(mine.coefficients.toArray() - theirs.coefficients.toArray()).max() < 1e-5
    assert abs(mine.intercept - theirs.intercept) < 1e-5 and mine.getOrDefault("regParam") == reg
    assert abs(metrics[0] - T.cross_validate(train, stats, cols, CAT, ref, [{}], 3, "y")[0]) < 1e-4


def test_two_folds_and_the_refit_share_the_passes(spark, rows, monkeypatch):
    from lateship.ml import logistic
    passes, one = [], logistic._pass
    monkeypatch.setattr(logistic, "_pass", lambda *a: passes.append(len(a[2])) or one(*a))
    monkeypatch.setattr(LogisticRegression, "fit", lambda *a: pytest.fail("prepared vectors"))
    r = T.train_and_select(rows, "Logistic Regression", ["id"], ["x", "const"], CAT, label="y")
    assert passes[0] == 3 and len(passes) <= 8
    r.release()


def test_other_logistic_fits_are_left_to_mllib(spark, rows):
    stats = merged(fold_statistics(rows, NUM, CAT))
    of = lambda **grid: T.classifier_and_grid("Logistic Regression", grid=grid)
    assert T.applies(*of(elasticNetParam=[0.0]), CAT, NUM, stats) and not T.applies(*of(elasticNetParam=[0.5]), CAT, NUM, stats)
    assert not T.applies(*of(maxIter=[3]), CAT, NUM, stats) and not T.applies(*T.classifier_and_grid("Random Forest"), CAT, NUM, stats)
    three = rows.withColumn("y", F.col("id") % 3)
    est, grid = T.classifier_and_grid("Logistic Regression", "y")
    assert T.newton_search(three, fold_statistics(rows, ["x"], CAT), ["x"], CAT, est, grid, 3, "y") is None
