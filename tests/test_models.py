from pyspark.sql import functions as F

from lateship.ml import train as T
from lateship.plans.q_features import model_input
from lateship.session import shared_dir


def test_lr_auc_save_load(spark, sf_dir):
    r = T.train_and_select(model_input(spark, sf_dir), "Logistic Regression", ["order_id", "line_no"])
    rep = T.evaluation_report(T.score(r.model, r.test), r.name).first()
    assert rep.auc > 0.70 and abs(rep.auc - rep.auc_exact) < 0.01
    assert 0.0 <= rep.weighted_f1 <= 1.0
    path = T.save_model(r.model, shared_dir(spark, "t-model"), r.name)
    assert path.endswith("logistic_regression")
    loaded = T.load_model(path)
    a = T.score(r.model, r.test).select("order_id", "line_no", F.col("probability").alias("p"))
    b = T.score(loaded, r.test).select("order_id", "line_no", F.col("probability").alias("p"))
    pa = sorted((x.order_id, x.line_no, tuple(x.p)) for x in a.collect())
    pb = sorted((x.order_id, x.line_no, tuple(x.p)) for x in b.collect())
    assert pa == pb
    view = T.prediction_view(T.score(r.model, r.test))
    assert view.columns == ["features_str", "prob_late", "prediction", "late_delivery_risk"]
    assert view.schema["prob_late"].dataType.simpleString() == "float"


def test_grid_points_returned_once(spark, sf_dir):
    r = T.train_and_select(model_input(spark, sf_dir), "Gradient-Boosted Trees (GBT)",
                           ["order_id", "line_no"], grid={"maxIter": [2, 3], "maxDepth": [2]})
    rows = r.grid_metrics.collect()
    assert sorted(x.params for x in rows) == ["maxDepth=2, maxIter=2", "maxDepth=2, maxIter=3"]
    assert all(0.5 < x.avg_auc <= 1.0 for x in rows)


def test_ensembles_are_fitted_on_counted_bins(spark):
    """Passes of the fits read as many rows as there are bins and categories;
    counts add up to all rows."""
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
    n = 6000
    rows = spark.range(n).select("id", F.rand(1).alias("x"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("c"))
    rows = rows.withColumn("y", (F.col("x") + F.when(F.col("c") == "a", 0.3).otherwise(0.0) + 0.2 * F.rand(2) > 0.7).cast("int")).cache()
    seen = []
    fits = {cls: cls._fit for cls in (GBTClassifier, RandomForestClassifier)}
    for cls, fit in fits.items():
        cls._fit = lambda self, df, fit=fit: seen.append((df.count(), df.agg(F.sum(self.getWeightCol())).first()[0])) or fit(self, df)
    try:
        gbt = T.train_and_select(rows, "Gradient-Boosted Trees (GBT)", ["id"], ["x"], ["c"], "y", grid={"maxIter": [3], "maxDepth": [3]})
        boosted, seen = seen, []
        forest = T.train_and_select(rows, "Random Forest", ["id"], ["x"], ["c"], "y", grid={"numTrees": [8]})
    finally:
        for cls, fit in fits.items():
            cls._fit = fit
    train = gbt.train.count()
    assert all(k <= 32 * 2 * 2 * 2 for k, _ in boosted) and boosted[-1][1] == train
    assert len(seen) == 3 * 8 and all(abs(w / train - 1) < 0.1 for _, w in seen[-8:]) and len({w for _, w in seen[-8:]}) > 1
    for r in (gbt, forest):
        path = T.save_model(r.model, shared_dir(spark, "t-bins"), r.name)
        a = T.score(r.model, r.test).select("id", "probability").collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, T.score(T.load_model(path), r.test).select("id", "probability").collect()))
        assert T.evaluation_report(T.score(r.model, r.test).withColumnRenamed("y", "late_delivery_risk"), r.name).first().auc > 0.9
    assert forest.model.stages[-1].getNumTrees == 8


def test_bins_of_few_and_many_values():
    from lateship.ml.bins import cut_points
    assert cut_points([1.0, 1.0, 2.0, 4.0]) == [1.5, 3.0]
    assert len(cut_points([float(i) for i in range(1025)])) == 31
    assert len(cut_points([5.0])) == 1 and len(cut_points([])) == 1
    assert cut_points([0.0] * 900 + [float(i) for i in range(125)])[0] > 0.0
