"""Binary logistic regression by Newton steps over narrow rows.

MLlib's fit reads, pass after pass, prepared vectors that are kept once for
every fold; they take several times the space of the columns they are made
from, and making them is most of the work. A Newton step needs only sums over
the rows: of residuals by feature and of weights by pair of features. Tasks
add them up from the columns as they are (numbers and labels), so nothing is
prepared or kept, and one pass serves all fits at once, of every fold and
grid point. Five or six passes reach the minimum that MLlib's iterations
approach: mean log-loss plus half of ``regParam`` times the squared
coefficients of the features scaled to unit deviation.

The sums are (features)^2 / 2 numbers a task and fit, which Spark adds up:
:data:`MAX_WIDTH` bounds the features; wider ones are left to MLlib.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.sketch import value_column
from .moments import FeatureStatistics

MAX_WIDTH = 300
#: Half the squared Newton decrement (what a step gains) after which a last step is taken.
GAIN = 1e-10


@dataclass
class Fit:
    """A fit on all rows but those of fold ``without``."""
    without: int | None
    point: int
    reg: float
    statistics: FeatureStatistics
    theta: np.ndarray | None = None     # intercept and coefficients of the scaled features


class Layout:
    """Places of the intercept, the numeric columns and the labels of all
    rows; a missing label has none."""

    def __init__(self, numeric: list[str], categorical: list[str], whole: FeatureStatistics):
        self.numeric, self.categorical = numeric, categorical
        self.labels = [whole.ordered_labels(c) for c in categorical]
        self.starts = np.cumsum([1 + len(numeric), *map(len, self.labels)]).tolist()
        self.width = self.starts[-1]

    def scales(self, s: FeatureStatistics) -> tuple[np.ndarray, np.ndarray]:
        """Mean of each numeric column, and 1 / deviation of each feature: 0
        for one that does not vary, whose coefficient is 0."""
        at = [s.imputed(c) for c in self.numeric]
        std = [1.0, *[d for _, d in at],
               *[s.indicator(c, v)[1] if v in s.labels[c] else 0.0 for c, vs in zip(self.categorical, self.labels) for v in vs]]
        return np.array([m for m, _ in at]), np.array([1.0 / d if d else 0.0 for d in std])

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """Numbers (NaN: missing), label places, class and fold of some rows."""
        x = np.array([np.asarray(batch[f"n{i}"].fill_null(np.nan).to_numpy(zero_copy_only=False)) for i in range(len(self.numeric))])
        codes = [pc.index_in(batch[f"c{i}"], value_set=pa.array(vs, pa.string())).fill_null(len(vs)).to_numpy(zero_copy_only=False).astype(np.int64)
                 for i, vs in enumerate(self.labels)]
        return (x.reshape(len(self.numeric), batch.num_rows), codes, batch["y"].to_numpy(zero_copy_only=False), batch["fold"].to_numpy(zero_copy_only=False))

    def margin(self, fit: tuple, x: np.ndarray, codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Scaled numbers (a missing one is the mean) and margins of the rows."""
        _, mean, inverse, theta = fit
        p = len(self.numeric)
        z = np.where(np.isnan(x), 0.0, (x - mean[:, None]) * inverse[1:1 + p, None])
        m = theta[0] + theta[1:1 + p] @ z
        for code, a, b in zip(codes, self.starts, self.starts[1:]):
            m = m + np.append(theta[a:b] * inverse[a:b], 0.0)[code]
        return z, m

    def sums(self, fit: tuple, x: np.ndarray, codes: list[np.ndarray], y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        """Of one fit: second derivatives, first derivatives, and loss, rows,
        rows of class 1 and rows of another class than 0 or 1. The derivatives
        are those of unscaled labels."""
        z, m = self.margin(fit, x, codes)
        use = np.ones(len(y)) if fit[0] is None else (fold != fit[0]).astype(float)
        e = np.exp(-np.abs(m))
        prob = np.where(m >= 0, 1.0, e) / (1.0 + e)
        r, w = (prob - y) * use, prob * (1.0 - prob) * use
        p = len(self.numeric)
        h, g = np.zeros((self.width, self.width)), np.zeros(self.width)
        one_z = np.vstack([np.ones(len(y)), z])
        wz = one_z * w
        h[:1 + p, :1 + p], g[:1 + p] = wz @ one_z.T, one_z @ r
        for i, (ci, ai, bi) in enumerate(zip(codes, self.starts, self.starts[1:])):
            g[ai:bi] = np.bincount(ci, r, bi - ai + 1)[:-1]
            for j in range(1 + p):
                h[j, ai:bi] = np.bincount(ci, wz[j], bi - ai + 1)[:-1]
            h[range(ai, bi), range(ai, bi)] = h[0, ai:bi]
            for cj, aj, bj in zip(codes[i + 1:], self.starts[i + 1:], self.starts[i + 2:]):
                n = bj - aj + 1
                h[ai:bi, aj:bj] = np.bincount(ci * n + cj, w, (bi - ai + 1) * n).reshape(-1, n)[:-1, :-1]
        loss = np.log1p(e) + np.maximum(m, 0.0) - y * m
        return np.concatenate([h[np.triu_indices(self.width)], g,
                               [loss @ use, use.sum(), (y == 1.0) @ use, ((y != 0.0) & (y != 1.0)) @ use]])


def width(categorical: list[str], numeric: list[str], whole: FeatureStatistics) -> int:
    return 1 + len(numeric) + sum(len(whole.labels[c]) for c in categorical)


def applies(classifier, grid: list[dict], categorical: list[str], numeric: list[str], whole: FeatureStatistics) -> bool:
    """Whether the fit is one that Newton steps reach: squared penalties, no
    bounds or weights, and features of bounded number."""
    if not isinstance(classifier, LogisticRegression) or width(categorical, numeric, whole) > MAX_WIDTH:
        return False
    known = {"featuresCol", "labelCol", "regParam", "elasticNetParam"}
    maps = [{**classifier._paramMap, **point} for point in grid]
    return all({q.name for q in m} <= known and not next((v for q, v in m.items() if q.name == "elasticNetParam"), 0.0) for m in maps)


def narrow(rows: DataFrame, numeric: list[str], categorical: list[str], label: str) -> DataFrame:
    return rows.select(*[value_column(c).alias(f"n{i}") for i, c in enumerate(numeric)],
                       *[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(categorical)],
                       F.col(label).cast("double").alias("y"), F.col("fold").cast("int").alias("fold"))


def _pass(rows: DataFrame, layout: Layout, fits: list[tuple]) -> list[np.ndarray]:
    """The sums of every fit, added up by Spark."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                data = layout.read(b)
                part = np.array([layout.sums(f, *data) for f in fits])
                total = part if total is None else total + part
        if total is not None:
            fit, place = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(fit.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(total[fit, place])],
                                             names=["fit", "place", "value"])

    size = layout.width * (layout.width + 1) // 2 + layout.width + 4
    out = np.zeros((len(fits), size))
    got = rows.mapInArrow(sums, "fit int, place int, value double").groupBy("fit", "place").agg(F.sum("value").alias("value")).toArrow()
    out[got["fit"].to_numpy(), got["place"].to_numpy()] = got["value"].to_numpy()
    return list(out)


def solve(rows: DataFrame, fits: list[Fit], layout: Layout, max_passes: int = 100) -> bool:
    """Give each fit its ``theta``; False if a fit's rows are not of the two
    classes 0 and 1. A step that does not lower the loss is halved."""
    d, upper = layout.width, np.triu_indices(layout.width)
    scales = [layout.scales(f.statistics) for f in fits]
    at = [np.zeros(d) for _ in fits]
    last: list[tuple | None] = [None] * len(fits)   # (theta, loss) of the last step that lowered the loss
    todo = list(range(len(fits)))
    for _ in range(max_passes):
        for i, s in zip(todo, _pass(rows, layout, [(fits[i].without, *scales[i], at[i]) for i in todo])):
            total, n, ones, others = s[-4:]
            if others or not 0 < ones < n:
                return False
            inverse, ridge = scales[i][1], np.full(d, fits[i].reg)
            ridge[0] = 0.0
            raw = np.where(np.arange(d) <= len(layout.numeric), (inverse > 0).astype(float), inverse)   # numbers came scaled
            loss = total / n + at[i] @ (ridge * at[i]) / 2
            if last[i] is not None and not loss <= last[i][1] + 1e-13:
                at[i] = (last[i][0] + at[i]) / 2
                if np.abs(at[i] - last[i][0]).max() > 1e-12:
                    continue
                at[i], fits[i].theta = last[i][0], last[i][0]
                continue
            h = np.zeros((d, d))
            h[upper] = s[:len(upper[0])]
            h = h + np.triu(h, 1).T
            g = raw * s[len(upper[0]):-4] / n + ridge * at[i]
            h = raw[:, None] * h * raw / n + np.diag(ridge)
            free = raw > 0
            step = np.zeros(d)
            step[free] = np.linalg.lstsq(h[np.ix_(free, free)], -g[free], rcond=None)[0]
            last[i], at[i] = (at[i], loss), at[i] + step
            if -g @ step / 2 < GAIN:
                fits[i].theta = at[i]
        todo = [i for i in todo if fits[i].theta is None]
        if not todo:
            return True
    for i in todo:
        fits[i].theta = last[i][0]
    return True


def held_margins(rows: DataFrame, fits: list[Fit], layout: Layout, points: int) -> DataFrame:
    """(fold, y, m0, m1, ...): the margin of each row under every grid point's
    fit that left its fold out."""
    of = {(f.without, f.point): (f.without, *layout.scales(f.statistics), f.theta) for f in fits if f.without is not None}

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, codes, y, fold = layout.read(b)
            out = np.zeros((points, len(y)))
            for (k, i), f in of.items():
                mine = fold == k
                out[i, mine] = layout.margin(f, x[:, mine], [c[mine] for c in codes])[1]
            yield pa.RecordBatch.from_arrays([pa.array(fold), pa.array(y), *map(pa.array, out)],
                                             names=["fold", "y", *[f"m{i}" for i in range(points)]])
    return rows.mapInArrow(margins, "fold int, y double, " + ", ".join(f"m{i} double" for i in range(points)))


def fitted_model(spark: SparkSession, classifier, params: dict, fit: Fit, layout: Layout) -> LogisticRegressionModel:
    """MLlib's model of the fit's coefficients, in the order of the fitted
    stages: numbers, then the labels of each column."""
    s, theta = fit.statistics, fit.theta
    place = {(c, v): a + j for c, vs, a in zip(layout.categorical, layout.labels, layout.starts) for j, v in enumerate(vs)}
    p = len(layout.numeric)
    mean, inverse = layout.scales(s)
    w = [*theta[1:1 + p], *[theta[place[c, v]] for c in layout.categorical for v in s.ordered_labels(c)]]
    estimator = classifier.copy(params)
    java = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        estimator.uid, _py2java(spark.sparkContext, Vectors.dense(w)), float(theta[0] - (theta[1:1 + p] * inverse[1:1 + p]) @ mean))
    return estimator._copyValues(LogisticRegressionModel(java))
