"""Tree ensembles fitted on binned rows.

A tree never looks at a number, only at the bin it falls in. So the numeric
features become bins first, bounded by quantiles of all rows that are fitted
on (sketches by fold, which merge), and rows of equal bins, labels and fold
become one row with their count as weight: a sum over rows is a weighted sum
over these. One aggregate reads the rows; the many passes of the fits read
its result, which is bounded by the bins and not by the rows. The bins are a
stage of the model, so a row is scored by the bins it was fitted in.

The bagging of a random forest draws each row a Poisson(1) number of times for
each tree; the draws of ``n`` equal rows add up to one of Poisson(``n``).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import Bucketizer, ElementwiseProduct, ImputerModel, StandardScalerModel, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from ..operators import sketch

#: Bins of a numeric feature: MLlib's default ``maxBins``.
BINS = 32
VECTOR, WEIGHT = "features_binned", "weight"
_STEPS = 256
#: Binned rows of one task.
_TASK_ROWS = 20_000


def cut_points(quantiles: list[float], bins: int = BINS) -> list[float]:
    """Inner bounds of at most ``bins`` bins: half way between neighbours if
    there are no more values than bins, else evenly spaced quantiles."""
    values = sorted({q for q in quantiles if math.isfinite(q)})
    if len(values) <= bins:
        cuts = [a + (b - a) / 2 for a, b in zip(values, values[1:])]
    else:
        cuts = sorted({quantiles[round(i * (len(quantiles) - 1) / bins)] for i in range(1, bins)})
        cuts = [c for c in cuts if math.isfinite(c) and c > values[0]]
    return sorted(set(cuts)) or [values[0] if values else 0.0]


def fold_cuts(rows: DataFrame, numeric: list[str], folds: int, fold: str = "fold") -> dict[int | None, list[list[float]]]:
    """Cut points of each numeric column for all folds but one, and (None) for
    all: one pass over the rows. A column without values has a cut anywhere."""
    if not numeric:
        return {k: [] for k in (None, *range(folds))}
    states = sketch.quantile_state(rows, numeric, by=[fold]).persist()   # one row a fold and column
    try:
        out = {}
        for k in (None, *range(folds)):
            part = states if k is None else states.where(F.col(fold) != k)
            probs = [i / _STEPS for i in range(_STEPS + 1)]
            got = {r["column_name"]: r["q"] for r in sketch.with_quantiles(sketch.merged_states(part), probs).collect()}
            out[k] = [cut_points(got.get(c, [])) for c in numeric]
        return out
    finally:
        states.unpersist()


def binned_stages(stages: list, numeric: list[str], categorical: list[str], cuts: list[list[float]]) -> list:
    """``stages`` (of :func:`.moments.fitted_stages`), the bins, and the vector
    of bins and one-hot columns."""
    bins = [f"{c}_bin" for c in numeric]
    out = list(stages)
    if numeric:
        bounds = [[-math.inf, *c, math.inf] for c in cuts]
        out.append(Bucketizer(splitsArray=bounds, inputCols=[f"{c}_imputed" for c in numeric], outputCols=bins, handleInvalid="error"))
    out.append(VectorAssembler(inputCols=bins + [f"{c}_onehot" for c in categorical], outputCol="features_bins", handleInvalid="error"))
    # drops the attributes, by which a tree would take bins for categories without order
    size = next(s for s in stages if isinstance(s, StandardScalerModel)).std.size
    out.append(ElementwiseProduct(scalingVec=Vectors.dense([1.0] * size), inputCol="features_bins", outputCol=VECTOR))
    return out


def binned_rows(train: DataFrame, stages: list, numeric: list[str], categorical: list[str], label: str) -> DataFrame:
    """(features_binned, label, fold, weight): the rows of equal bins,
    categories, label and fold as one, with their number."""
    numbers = [s for s in stages if isinstance(s, (ImputerModel, Bucketizer))]
    bins = [f"{c}_bin" for c in numeric]
    counted = (PipelineModel(stages=numbers).transform(train).groupBy(*bins, *categorical, label, "fold")
               .agg(F.count(F.lit(1)).cast("double").alias(WEIGHT)))
    rest = [s for s in stages if s not in numbers and not isinstance(s, StandardScalerModel)
            and not (isinstance(s, VectorAssembler) and s.getOutputCol() == "features_unscaled")]
    return PipelineModel(stages=rest).transform(counted).select(VECTOR, label, "fold", WEIGHT)


def fit_size(rows: DataFrame) -> DataFrame:
    """``rows`` (persisted) in as many partitions as they need."""
    return rows.coalesce(max(1, -(-rows.count() // _TASK_ROWS)))


def _draws(trees: int, seed: int):
    """UDF: how often each tree draws a row of the given weight. Seeded by the
    rows of the batch, so that a task that runs again draws the same."""
    @F.pandas_udf("array<double>")
    def draw(key: pd.Series, weight: pd.Series) -> pd.Series:
        if not len(key):
            return pd.Series([], dtype=object)
        rng = np.random.default_rng([seed, len(key), int(key.iloc[0]) & 0xFFFFFFFF, int(key.iloc[-1]) & 0xFFFFFFFF])
        return pd.Series(list(rng.poisson(weight.to_numpy()[:, None], (len(key), trees)).astype(float)))
    return draw


def fit_forest(classifier, rows: DataFrame, params: dict) -> RandomForestClassificationModel:
    """A random forest: each tree is fitted by MLlib on its own draws of the
    rows, which are weighted by their number."""
    whole = classifier.copy(params)
    n, seed, label = whole.getNumTrees(), whole.getSeed(), whole.getLabelCol()
    if whole.getSubsamplingRate() != 1.0 or not whole.getBootstrap():
        raise ValueError("only bootstrap samples of the size of the rows are drawn")
    subset = whole.getFeatureSubsetStrategy()
    classes = int(rows.agg(F.max(label)).first()[0]) + 1
    one = whole.copy().setNumTrees(1).setBootstrap(False).setWeightCol("drawn")
    one = one.setFeatureSubsetStrategy("sqrt" if subset == "auto" and n > 1 else subset)
    nominal = F.col(label).alias(label, metadata={"ml_attr": {"type": "nominal", "num_vals": max(classes, 2)}})
    drawn = rows.select(VECTOR, nominal, _draws(n, seed)(F.xxhash64(*[F.col(c) for c in rows.columns if c != VECTOR]), WEIGHT).alias("draws")).persist()
    try:
        gateway = SparkContext._active_spark_context._gateway
        ml = gateway.jvm.org.apache.spark.ml.classification
        trees = gateway.new_array(ml.DecisionTreeClassificationModel, n)
        for t in range(n):
            tree = drawn.select(VECTOR, label, F.col("draws")[t].alias("drawn")).where("drawn > 0")
            fitted = one.setSeed(seed + t).fit(tree)
            trees[t] = fitted._java_obj.trees()[0]
        forest = ml.RandomForestClassificationModel(whole.uid, trees, fitted.numFeatures, fitted.numClasses)
        for name in ("featuresCol", "labelCol", "predictionCol", "rawPredictionCol", "probabilityCol"):
            forest.set(forest.getParam(name), whole.getOrDefault(name))
        forest.set(forest.getParam("numTrees"), n)   # a saved model states it
        return RandomForestClassificationModel(forest)
    finally:
        drawn.unpersist()
