"""Feature statistics by fold, and feature stages fitted from them.

Two aggregates over the training rows give, for each fold, counts, means and
sums of squared deviations of the numeric columns, and the count of each
label of the categorical ones. Statistics of disjoint folds merge, so the
stages for "all folds but one" and for "all folds" follow without another
pass: nothing is fitted on the data again, whatever the number of folds.

Moments are merged (Chan et al.), not subtracted as raw sums of squares, so
a large mean costs no digits.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.sketch import value_column


@dataclass
class Moments:
    """Number of values, mean and sum of squared deviations."""
    n: int = 0
    mean: float = 0.0
    m2: float = 0.0

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return Moments()
        d = other.mean - self.mean
        return Moments(n, self.mean + d * other.n / n, self.m2 + other.m2 + d * d * self.n * other.n / n)


@dataclass
class FeatureStatistics:
    """What the feature stages need to know of a set of rows."""
    rows: int
    moments: dict[str, Moments]
    labels: dict[str, dict[str, int]]

    def __add__(self, other: FeatureStatistics) -> FeatureStatistics:
        labels = {}
        for c in self.labels:
            both = dict(self.labels[c])
            for v, n in other.labels[c].items():
                both[v] = both.get(v, 0) + n
            labels[c] = both
        return FeatureStatistics(self.rows + other.rows, {c: m + other.moments[c] for c, m in self.moments.items()}, labels)

    def ordered_labels(self, c: str) -> list[str]:
        """Labels by descending frequency, ties in Java's string order."""
        return sorted(self.labels[c], key=lambda v: (-self.labels[c][v], v.encode("utf-16-be")))

    def imputed(self, c: str) -> tuple[float, float]:
        """Mean and sample standard deviation after missing values became the mean."""
        m = self.moments[c]
        return m.mean, math.sqrt(max(m.m2, 0.0) / (self.rows - 1)) if self.rows > 1 else 0.0

    def indicator(self, c: str, label: str) -> tuple[float, float]:
        """Mean and sample standard deviation of a label's 0/1 column."""
        k, n = self.labels[c][label], self.rows
        return k / n, math.sqrt(k * (n - k) / (n * (n - 1))) if n > 1 else 0.0


def fold_statistics(rows: DataFrame, numeric: list[str], categorical: list[str], fold: str = "fold") -> dict[int, FeatureStatistics]:
    """Statistics of each fold: one aggregate for the numeric columns and one
    for the labels. Folds x labels rows reach the driver, as the labels of a
    fitted indexer do."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(numeric):
        v = value_column(c)
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"a{i}"), F.var_pop(v).alias(f"v{i}")]
    out = {}
    for r in rows.groupBy(fold).agg(*aggs).collect():
        m = {c: Moments(r[f"n{i}"], r[f"a{i}"] or 0.0, (r[f"v{i}"] or 0.0) * r[f"n{i}"]) for i, c in enumerate(numeric)}
        out[r[fold]] = FeatureStatistics(r["rows"], m, {c: {} for c in categorical})
    if categorical:
        long = rows.select(fold, *[F.col(c).cast("string").alias(c) for c in categorical]).unpivot(fold, categorical, "c", "v")
        for r in long.where("v IS NOT NULL").groupBy(fold, "c", "v").count().collect():
            out[r[fold]].labels[r["c"]][r["v"]] = r["count"]
    return out


def merged(statistics: dict[int, FeatureStatistics], without: int | None = None) -> FeatureStatistics:
    """The statistics of all folds, or of all but one."""
    parts = [s for k, s in sorted(statistics.items()) if k != without]
    if not parts:
        raise ValueError("no rows to fit the features on")
    total = parts[0]
    for s in parts[1:]:
        total = total + s
    return total


def check_values(s: FeatureStatistics, numeric: list[str]) -> None:
    empty = [c for c in numeric if not s.moments[c].n]
    if empty:
        raise ValueError(f"no value to impute from in {empty}")


def fitted_stages(spark: SparkSession, s: FeatureStatistics, numeric: list[str], categorical: list[str],
                  with_mean: bool = True) -> list:
    """The fitted stages of :func:`..stages.feature_stages`, from statistics.

    The stages are MLlib's own and are saved and loaded as usual: those that
    cannot be made from parameters are fitted on one or two rows that have
    the very mean and deviation. With ``with_mean`` there are two scalers:
    ``features_scaled`` is sparse and not centred, for fitting and scoring,
    ``features`` is centred (and only computed where it is selected).
    """
    check_values(s, numeric)
    imputed, indexed, onehot = ([f"{c}_{x}" for c in cols] for cols, x in ((numeric, "imputed"), (categorical, "index"), (categorical, "onehot")))
    labels = [s.ordered_labels(c) for c in categorical]
    schema = ", ".join([*[f"`{c}` double" for c in numeric], *[f"`{c}` string" for c in categorical]])
    one = spark.createDataFrame([(*[s.moments[c].mean for c in numeric], *[(x or [None])[0] for x in labels])], schema)
    stages = []
    if numeric:
        stages.append(Imputer(inputCols=numeric, outputCols=imputed, strategy="mean").fit(one))
    if categorical:
        index = [StringIndexerModel.from_labels(x, inputCol=c, outputCol=i, handleInvalid="keep") for x, c, i in zip(labels, categorical, indexed)]
        encoder = OneHotEncoder(inputCols=indexed, outputCols=onehot, dropLast=True).fit(PipelineModel(stages=index).transform(one))
        stages += [*index, encoder]
    stages.append(VectorAssembler(inputCols=imputed + onehot, outputCol="features_unscaled", handleInvalid="error"))
    at = [s.imputed(c) for c in numeric] + [s.indicator(c, v) for c, vs in zip(categorical, labels) for v in vs]
    h = math.sqrt(0.5)  # mean - h * std and mean + h * std have that mean and deviation
    two = spark.createDataFrame([(Vectors.dense([m - h * d for m, d in at]),), (Vectors.dense([m + h * d for m, d in at]),)],
                                ["features_unscaled"]).coalesce(1)
    scaler = lambda out, centre: StandardScaler(inputCol="features_unscaled", outputCol=out, withMean=centre, withStd=True).fit(two)
    return [*stages, scaler("features_scaled", False), scaler("features", True)] if with_mean else [*stages, scaler("features", False)]
