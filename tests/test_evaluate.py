from lateship.ml import train as T
from lateship.operators import evaluate


def test_square_confusion_loses_no_row(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (0, None), (0, 0.0), (None, 1.0)], "late_delivery_risk int, prediction double")
    got = {r.actual: (r.pred_0, r.pred_1, r.pred_other) for r in evaluate.confusion_square(df).collect()}
    assert got == {1.0: (0, 1, 1), 0.0: (1, 0, 1), None: (0, 1, 0)}


def test_report_of_a_single_class(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(1, 1.0, Vectors.dense([-1.0, 1.0]), Vectors.dense([0.2, 0.8])), (1, 0.0, Vectors.dense([1.0, -1.0]), Vectors.dense([0.7, 0.3]))]
    r = T.evaluation_report(spark.createDataFrame(rows, ["late_delivery_risk", "prediction", "rawPrediction", "probability"]), "m").first()
    assert r.auc_exact is None and r.accuracy == 0.5
