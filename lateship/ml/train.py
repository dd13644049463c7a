"""Training with cross-validation, model persistence, scoring and reports.

Data movement: the narrow training rows are written once to the shared folder,
with their split part and fold. Two aggregates over them give the feature
statistics of every fold, from which the stages of each fit follow
(:mod:`.moments`). Each fold's prepared rows (vector, label and fold) are the
only copy that is persisted; the whole grid is searched on them. The
classifiers are fitted on sparse scaled vectors: centring moves the intercept
of a linear model only, and no split of a tree. Tree ensembles are fitted on
binned rows, counted (:mod:`.bins`): their passes read no more rows than
there are combinations of bins. Logistic regression with squared penalties is
fitted on the written rows themselves, every fold and grid point in the same
passes (:mod:`.logistic`), so that no vectors are prepared for it.

The split and the folds are key hashes by default, so they are reproducible,
disjoint, and survive recomputation after an executor loss.
"""

from __future__ import annotations

from contextlib import ExitStack, contextmanager
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..functions.expr import slug_text
from ..operators.clean import hash_bucket, split_part
from ..operators.evaluate import classification_metrics
from ..operators.stats import auc_exact
from ..schema import LABEL
from ..session import delete_path, shared_dir
from .bins import VECTOR, WEIGHT, binned_rows, binned_stages, fit_forest, fit_size, fold_cuts
from .logistic import Fit, Layout, applies, fitted_model, held_margins, narrow, solve
from .moments import FeatureStatistics, Moments, check_values, fitted_stages, fold_statistics, merged
from .stages import classifier_and_grid, feature_columns


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


@dataclass
class TrainResult:
    name: str
    model: PipelineModel
    grid_metrics: DataFrame
    train: DataFrame
    test: DataFrame
    statistics: FeatureStatistics
    rows_path: str

    def release(self) -> None:
        """Delete the written rows that ``train`` and ``test`` read."""
        delete_path(self.train.sparkSession, self.rows_path)


def _describe(params: dict) -> str:
    return ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda kv: kv[0].name))


def boosting_prefix(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The first ``n`` trees of a boosted model: what fitting with
    ``maxIter=n`` and the same other parameters gives."""
    gateway = SparkContext._active_spark_context._gateway
    java = model._java_obj
    kind = gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees, weights = gateway.new_array(kind, n), gateway.new_array(gateway.jvm.double, n)
    for i in range(n):
        trees[i], weights[i] = java.trees()[i], java.treeWeights()[i]
    first = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights)
    for name in ("featuresCol", "predictionCol", "rawPredictionCol", "probabilityCol"):
        first.set(first.getParam(name), model.getOrDefault(name))
    return GBTClassificationModel(first)


def _fits(classifier, grid: list[dict]) -> list[tuple[dict, list[tuple[int, int | None]]]]:
    """What to fit: ``(params, [(grid point, trees)])``. Boosting adds tree
    after tree, so of points that differ in ``maxIter`` alone only the
    longest is fitted, and the others are its first trees."""
    it = classifier.getParam("maxIter") if classifier.hasParam("maxIter") and classifier.hasParam("stepSize") else None
    if it is None:
        return [(p, [(i, None)]) for i, p in enumerate(grid)]
    groups: dict[tuple, list[int]] = {}
    for i, p in enumerate(grid):
        groups.setdefault(tuple(sorted((q.name, repr(v)) for q, v in p.items() if q != it)), []).append(i)
    of = lambda i: grid[i].get(it, classifier.getOrDefault(it))
    return [(grid[max(points, key=of)], [(i, of(i)) for i in points]) for points in groups.values()]


def _on_bins(classifier) -> bool:
    """Whether the classifier is one that looks at bins only."""
    return isinstance(classifier, (GBTClassifier, RandomForestClassifier))


def _fit(classifier, rows: DataFrame, params: dict):
    return fit_forest(classifier, rows, params) if isinstance(classifier, RandomForestClassifier) else classifier.fit(rows, params)


def cross_validate(train: DataFrame, statistics: dict[int, FeatureStatistics], numeric: list[str], categorical: list[str],
                   classifier, grid: list[dict], num_folds: int, label: str, with_mean: bool = True, parallelism: int = 1,
                   cuts: dict | None = None) -> list[float]:
    """Mean area under ROC of each grid point over the folds in ``fold``.

    A fold's feature stages come from the statistics of the other folds (for
    tree ensembles, also its ``cuts``); its prepared rows are persisted, and
    every grid point is fitted and measured on them. ``parallelism`` fits run
    at a time.
    """
    weight = {"weightCol": WEIGHT} if cuts else {}
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", **weight)
    spark, vector = train.sparkSession, classifier.getOrDefault("featuresCol")
    total = [[0.0] * num_folds for _ in grid]

    def one(job) -> None:
        k, prepared, params, points = job
        model = _fit(classifier, prepared.filter(F.col("fold") != k), params)
        held = prepared.filter(F.col("fold") == k)
        for i, trees in points:
            part = model if trees is None or trees >= model.getNumTrees else boosting_prefix(model, trees)
            total[i][k] = evaluator.evaluate(part.transform(held))

    with ExitStack() as stack:
        jobs = []
        for k in range(num_folds):
            stages = fitted_stages(spark, merged(statistics, without=k), numeric, categorical, with_mean)
            if cuts:
                prepared = binned_rows(train, binned_stages(stages, numeric, categorical, cuts[k]), numeric, categorical, label)
                prepared = fit_size(stack.enter_context(persisted(prepared)))
            else:
                prepared = PipelineModel(stages=stages).transform(train).select(vector, label, "fold")
                stack.enter_context(persisted(prepared))
            jobs += [(k, prepared, params, points) for params, points in _fits(classifier, grid)]
        if parallelism > 1:
            pool = stack.enter_context(ThreadPool(min(parallelism, len(jobs))))
            pool.map(inheritable_thread_target(spark)(one), jobs, chunksize=1)
        else:
            for job in jobs:
                one(job)
    return [sum(t) / num_folds for t in total]


def newton_search(train: DataFrame, statistics: dict[int, FeatureStatistics], numeric: list[str], categorical: list[str],
                  classifier, grid: list[dict], num_folds: int, label: str) -> tuple[list[float], list, Layout] | None:
    """:func:`cross_validate` and the refits of a logistic regression: mean
    area under ROC and whole fit of each grid point. None if the labels are
    not of two classes."""
    layout = Layout(numeric, categorical, merged(statistics))
    reg = [float(next((v for q, v in p.items() if q.name == "regParam"), classifier.getRegParam())) for p in grid]
    fits = [Fit(k, i, r, merged(statistics, without=k)) for k in [*range(num_folds), None] for i, r in enumerate(reg)]
    for f in fits:
        check_values(f.statistics, numeric)
    rows = narrow(train, numeric, categorical, label)
    if not solve(rows, fits, layout, classifier.getMaxIter()):
        return None
    metrics = []
    with persisted(held_margins(rows, fits, layout, len(grid))) as held:
        for i in range(len(grid)):
            evaluator = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol=f"m{i}", metricName="areaUnderROC")
            metrics.append(sum(evaluator.evaluate(held.where(F.col("fold") == k)) for k in range(num_folds)) / num_folds)
    return metrics, [f for f in fits if f.without is None], layout


def train_and_select(df: DataFrame, name: str, key_cols: list[str], numeric=None,
                     categorical=None, label: str = LABEL, num_folds: int = 2,
                     seed: int = 42, grid: dict | None = None, with_mean: bool = True,
                     split: str = "hash", num_partitions: int | None = None, parallelism: int = 4) -> TrainResult:
    """80/20 split, k-fold cross-validation over the grid by area under ROC,
    best grid point refit on the whole training part.

    ``split``: ``"hash"`` of ``key_cols`` or ``"random"`` (a seeded draw for
    each row; it depends on the partitioning, but is written with the rows,
    so that both parts agree for good). ``with_mean`` centres the ``features``
    column of scored rows; the fit itself is on sparse vectors either way.
    ``num_partitions`` hash-partitions the rows on their key; a random
    forest's bagging is seeded per partition, so the fitted trees depend on
    the partitioning. ``parallelism`` fits of the search run at a time.
    """
    numeric, categorical = feature_columns(df, numeric, categorical)
    if split not in ("hash", "random"):
        raise ValueError(f"unknown split {split!r}")
    spark = df.sparkSession
    cols = list(dict.fromkeys([*key_cols, *numeric, *categorical, label]))
    by_key = key_cols or numeric + categorical
    part = split_part(key_cols, salt=str(seed)) if split == "hash" else F.when(F.rand(seed) < 0.8, "train").otherwise("test")
    data = df.select(*cols).na.drop(subset=[label])
    if num_partitions:
        data = data.repartition(num_partitions, *by_key)
    path = f"{shared_dir(spark, 'training')}/rows"
    data.withColumn("__part", part).withColumn("fold", hash_bucket(key_cols, num_folds, "fold")).write.option("compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)
    train, test = rows.filter("__part = 'train'").drop("__part"), rows.filter("__part = 'test'").drop("__part", "fold")
    if num_partitions:
        train = train.repartition(num_partitions, *by_key)
    statistics = fold_statistics(train, numeric, categorical)
    for k in range(num_folds):
        statistics.setdefault(k, FeatureStatistics(0, {c: Moments() for c in numeric}, {c: {} for c in categorical}))
    vector = "features_scaled" if with_mean else "features"
    classifier, params = classifier_and_grid(name, label, seed, grid, vector)
    cuts = None
    if _on_bins(classifier):
        cuts = fold_cuts(train, numeric, num_folds)
        classifier = classifier.setFeaturesCol(VECTOR).setWeightCol(WEIGHT)
    searched = None
    if applies(classifier, params, categorical, numeric, merged(statistics)):
        searched = newton_search(train, statistics, numeric, categorical, classifier, params, num_folds, label)
    # One grid point wins without a search, but its metric is reported too.
    metrics = searched[0] if searched else cross_validate(
        train, statistics, numeric, categorical, classifier, params, num_folds, label, with_mean, parallelism, cuts)
    best = max(range(len(params)), key=lambda i: metrics[i])
    whole = merged(statistics)
    stages = fitted_stages(spark, whole, numeric, categorical, with_mean)
    if searched:
        last = fitted_model(spark, classifier, params[best], searched[1][best], searched[2])
    elif cuts:
        stages = binned_stages(stages, numeric, categorical, cuts[None])
        with persisted(binned_rows(train, stages, numeric, categorical, label)) as prepared:
            last = _fit(classifier, fit_size(prepared), params[best])
    else:
        with persisted(PipelineModel(stages=stages).transform(train).select(vector, label)) as prepared:
            last = classifier.fit(prepared, params[best])
    model = PipelineModel(stages=[*stages, last])
    points = [(name, _describe(p), float(m)) for p, m in zip(params, metrics)]
    grid_df = spark.createDataFrame(points, "model string, params string, avg_auc double")
    return TrainResult(name, model, grid_df, train.drop("fold"), test, whole, path)


def centred_coefficients(result: TrainResult) -> tuple[list[float], float]:
    """Coefficients and intercept of a linear model on the centred
    ``features``: the coefficients are those of the sparse fit, the means go
    into the intercept."""
    last, scaler = result.model.stages[-1], result.model.stages[-2]
    w = last.coefficients.toArray()
    shift = [m / d if d else 0.0 for m, d in zip(scaler.mean.toArray(), scaler.std.toArray())]
    return w.tolist(), float(last.intercept + sum(a * b for a, b in zip(w, shift)))


def model_dir(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{slug_text(name)}"


def save_model(model: PipelineModel, base: str, name: str) -> str:
    """Overwrite-save the pipeline under ``<base>/<slug of name>``."""
    path = model_dir(base, name)
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def prediction_view(pred: DataFrame, label: str = LABEL) -> DataFrame:
    """features as text, P(late) as float32, prediction, label -- no Python UDF."""
    arr = vector_to_array(F.col("features"))
    text = F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: x.cast("string")), ","), F.lit("]"))
    return pred.select(text.alias("features_str"),
                       vector_to_array(F.col("probability"))[1].cast("float").alias("prob_late"),
                       F.col("prediction").cast("double").alias("prediction"),
                       F.col(label).alias(label))


def evaluation_report(pred: DataFrame, name: str, label: str = LABEL) -> DataFrame:
    """One row: model, AUC (evaluator, binned), exact AUC, accuracy and the
    weighted metrics. The scored table is persisted once for the three
    aggregate jobs; only their scalar results reach the driver."""
    with persisted(pred.select(label, "prediction", "rawPrediction", "probability")) as p:
        auc_binned = BinaryClassificationEvaluator(labelCol=label).evaluate(p)
        scored = p.select(label, vector_to_array("probability")[1].alias("p1"))
        auc = auc_exact(scored, label, "p1").first()["auc"]
        m = classification_metrics(p, label, "prediction").first().asDict()
    row = (name, float(auc_binned), None if auc is None else float(auc), m["accuracy"], m["weighted_precision"],
           m["weighted_recall"], m["weighted_f1"])
    return pred.sparkSession.createDataFrame(
        [row], "model string, auc double, auc_exact double, accuracy double, "
               "weighted_precision double, weighted_recall double, weighted_f1 double")
