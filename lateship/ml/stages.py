"""MLlib pipeline construction: feature stages and the three classifiers."""

from __future__ import annotations

from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import (Imputer, OneHotEncoder, StandardScaler,
                                StringIndexer, VectorAssembler)
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame

from ..schema import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES


def feature_columns(df: DataFrame, numeric=None, categorical=None):
    """Numeric and categorical feature lists for ``df``.

    The destination columns are optional: the distance feature is used when
    the gazetteer columns exist; without them it must already be present.
    """
    numeric = list(numeric or NUMERIC_FEATURES)
    categorical = list(categorical or CATEGORICAL_FEATURES)
    missing = [c for c in numeric + categorical if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    return numeric, categorical


def feature_stages(numeric: list[str], categorical: list[str],
                   with_mean: bool = True) -> list:
    """Imputer -> StringIndexer -> OneHotEncoder -> VectorAssembler -> StandardScaler."""
    imputed = [f"{c}_imputed" for c in numeric]
    indexed = [f"{c}_index" for c in categorical]
    onehot = [f"{c}_onehot" for c in categorical]
    return [
        Imputer(inputCols=numeric, outputCols=imputed, strategy="mean"),
        StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep",
                      stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCols=indexed, outputCols=onehot, dropLast=True),
        VectorAssembler(inputCols=imputed + onehot, outputCol="features_unscaled",
                        handleInvalid="error"),
        StandardScaler(inputCol="features_unscaled", outputCol="features",
                       withMean=with_mean, withStd=True),
    ]


# The model names a user chooses from, and the parameter grid
# searched for each (values to reproduce the reference's training).
MODEL_NAMES = ["Logistic Regression", "Random Forest", "Gradient-Boosted Trees (GBT)"]
DEFAULT_GRIDS = {
    "Logistic Regression": {"regParam": [0.01]},
    "Random Forest": {"numTrees": [20]},
    "Gradient-Boosted Trees (GBT)": {"maxIter": [20, 50], "maxDepth": [3, 5]},
}


def classifier_and_grid(name: str, label: str = LABEL, seed: int = 42,
                        grid: dict | None = None, features: str = "features"):
    """The estimator and its parameter grid for a model name.

    Grids are :data:`DEFAULT_GRIDS`; ``grid`` overrides values by parameter
    name (e.g. smaller grids in tests). Unknown names raise.
    """
    if name == "Logistic Regression":
        est = LogisticRegression(featuresCol=features, labelCol=label)
    elif name == "Random Forest":
        est = RandomForestClassifier(featuresCol=features, labelCol=label, seed=seed)
    elif name == "Gradient-Boosted Trees (GBT)":
        est = GBTClassifier(featuresCol=features, labelCol=label, seed=seed)
    else:
        raise ValueError(f"unknown model name {name!r}; expected one of {MODEL_NAMES}")
    values = dict(DEFAULT_GRIDS[name])
    values.update(grid or {})
    builder = ParamGridBuilder()
    for pname, vals in values.items():
        builder = builder.addGrid(est.getParam(pname), list(vals))
    return est, builder.build()
