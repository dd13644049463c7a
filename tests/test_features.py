import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array

from lateship.ml.stages import classifier_and_grid, feature_columns, feature_stages
from lateship.operators.features import string_index_mapping


def _df(spark):
    rows = [("b", 1.0), ("a", 2.0), ("b", None), ("a", float("nan")), ("c", 5.0), (None, 1.0)]
    return spark.createDataFrame(rows, "cat string, x double")


def test_index_ties_alphabetical_nulls_not_counted(spark):
    m = {r.value: r["index"] for r in string_index_mapping(_df(spark), ["cat"]).collect()}
    assert m == {"a": 0.0, "b": 1.0, "c": 2.0}


def test_pipeline_unseen_and_null_categories(spark):
    df = _df(spark)
    model = Pipeline(stages=feature_stages(["x"], ["cat"])[:3]).fit(df)
    test = spark.createDataFrame([("zzz", 1.0), (None, 1.0), ("a", None)], "cat string, x double")
    out = model.transform(test).select("cat_index", vector_to_array("cat_onehot").alias("oh"), "x_imputed").collect()
    assert out[0].cat_index == 3.0 and out[1].cat_index == 3.0
    assert out[0].oh == [0.0, 0.0, 0.0] and out[1].oh == [0.0, 0.0, 0.0]
    assert out[2].oh == [1.0, 0.0, 0.0]
    assert abs(out[2].x_imputed - (1.0 + 2.0 + 5.0 + 1.0) / 4) < 1e-12  # NaN and null ignored


def test_feature_columns_and_unknown_model(spark):
    df = _df(spark)
    with pytest.raises(ValueError):
        feature_columns(df, ["x", "distance_km"], ["cat"])
    with pytest.raises(ValueError):
        classifier_and_grid("Naive Bayes")
    est, grid = classifier_and_grid("Gradient-Boosted Trees (GBT)")
    assert len(grid) == 4
