"""The three classifiers, their tuning and their comparison, on MLlib."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import chain
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from .features import feature_stages, fold_number

LABEL = "label"
CREDIT_LABEL = "credit_label"
VECTOR = "scaled_features"


# The settings of the three classifiers and the grid.
def logistic_regression(max_iter: int = 100, reg_param: float = 0.01) -> LogisticRegression:
    return LogisticRegression(
        featuresCol=VECTOR, labelCol=LABEL, maxIter=max_iter, regParam=reg_param, elasticNetParam=0.0, family="binomial"
    )


def random_forest(trees: int = 100, depth: int = 6, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=VECTOR, labelCol=LABEL, numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt"
    )


def boosted_trees(rounds: int = 50, depth: int = 5, step: float = 0.1, seed: int = 42) -> GBTClassifier:
    return GBTClassifier(
        featuresCol=VECTOR, labelCol=CREDIT_LABEL, maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed
    )


def lr_grid(lr: LogisticRegression) -> list[dict]:
    return ParamGridBuilder().addGrid(lr.regParam, [0.01, 0.1]).addGrid(lr.maxIter, [50, 100]).build()


def exact_auc(label: str) -> BinaryClassificationEvaluator:
    """Area under ROC over every distinct score; the default would thin the curve to about a thousand points."""
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0)


def _prepare(train: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> PipelineModel:
    return Pipeline(stages=feature_stages(categorical, numeric)).fit(train)


def _fit_on_features(estimator, prepared: PipelineModel, train: DataFrame) -> PipelineModel:
    """Fit the classifier on stored vectors: tree and gradient passes then skip the feature steps."""
    shared_folder(train.sparkSession)  # boosting cuts its lineage there every few rounds
    vectors = prepared.transform(train).select(estimator.getLabelCol(), VECTOR)
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel([*prepared.stages, estimator.fit(vectors)])
    finally:
        vectors.unpersist()


def fit_classifier(estimator, train: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> PipelineModel:
    return _fit_on_features(estimator, _prepare(train, categorical, numeric), train)


@dataclass
class GridResult:
    model: PipelineModel
    metrics: DataFrame  # reg_param, max_iter, avg_auc, best


def tune_logistic_regression(
    train: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    key: Sequence[str],
    folds: int = 3,
    parallelism: int = 4,
) -> GridResult:
    """Choose the regularisation and iteration limit by cross-validated AUC, then refit on all rows.

    The feature steps are fitted once per fold, on that fold's training rows, and shared by all grid
    points; a cross-validator around the whole pipeline would fit them once per grid point as well.
    Points that differ in the iteration limit alone take the same steps: if a fit ends by itself before
    its limit, a larger limit gives that very model, so its figure holds for both. Else both are fitted.
    """
    lr = logistic_regression()
    grid = lr_grid(lr)
    paths = {}
    for i in sorted(range(len(grid)), key=lambda i: grid[i][lr.maxIter]):
        paths.setdefault(grid[i][lr.regParam], []).append(i)
    paths = list(paths.values())
    evaluator = exact_auc(LABEL)
    needed = [LABEL, *categorical, *numeric]
    rows = train.select(*dict.fromkeys(needed), fold_number(key, folds).alias("fold"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    totals = [0.0] * len(grid)
    try:
        for fold in range(folds):
            prepared = _prepare(rows.filter(F.col("fold") != fold), categorical, numeric)
            vectors = prepared.transform(rows).select(LABEL, "fold", VECTOR).persist(StorageLevel.MEMORY_AND_DISK)
            fitting, checking = vectors.filter(F.col("fold") != fold), vectors.filter(F.col("fold") == fold)

            def aucs(points, fitting=fitting, checking=checking):
                found, ended = {}, False
                for i in points:
                    if not ended:
                        model = lr.fit(fitting, grid[i])
                        auc, ended = evaluator.evaluate(model.transform(checking)), model.summary.totalIterations < grid[i][lr.maxIter]
                    found[i] = auc
                return found

            try:
                with ThreadPool(parallelism) as pool:
                    found = dict(chain.from_iterable(f.items() for f in pool.map(inheritable_thread_target(train.sparkSession)(aucs), paths)))
                totals = [t + found[i] for i, t in enumerate(totals)]
            finally:
                vectors.unpersist()
        best = max(range(len(grid)), key=lambda i: totals[i])
        model = _fit_on_features(lr.copy(grid[best]), _prepare(rows, categorical, numeric), rows)
    finally:
        rows.unpersist()
    table = [
        (float(p[lr.regParam]), int(p[lr.maxIter]), totals[i] / folds, i == best) for i, p in enumerate(grid)
    ]
    schema = "reg_param double, max_iter int, avg_auc double, best boolean"
    return GridResult(model, train.sparkSession.createDataFrame(table, schema))


def score(model: PipelineModel, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Predictions with the probability of class 1."""
    predicted = model.transform(rows)
    return predicted.select(
        *keep, "rawPrediction", "prediction", vector_to_array("probability")[1].alias("probability_1")
    )


def evaluate(predictions: DataFrame, label: str = LABEL) -> tuple[float, float]:
    """Accuracy and area under ROC on held-out rows."""
    predictions = predictions.select(label, "rawPrediction", "prediction").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        accuracy = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy").evaluate(predictions)
        auc = exact_auc(label).evaluate(predictions)
    finally:
        predictions.unpersist()
    return accuracy, auc


def comparison(spark: SparkSession, results: dict[str, tuple[float, float]]) -> DataFrame:
    """One row per model with accuracy, AUC and a flag for the best AUC."""
    best = max(results, key=lambda name: results[name][1])
    rows = [(name, acc, auc, name == best) for name, (acc, auc) in results.items()]
    return spark.createDataFrame(rows, "model string, accuracy double, auc double, best boolean")


def _slot_names(model: PipelineModel, sample: DataFrame) -> list[str]:
    """Names of the vector slots, from the metadata of the assembled column."""
    unscaled = PipelineModel([s for s in model.stages[:-2]]).transform(sample.limit(0))
    attributes = unscaled.schema["features"].metadata["ml_attr"]["attrs"]
    slots = [a for kind in attributes.values() for a in kind]
    return [a["name"] for a in sorted(slots, key=lambda a: a["idx"])]


def feature_importances(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Importance of every vector slot, numbered, under its own name."""
    importances = model.stages[-1].featureImportances.toArray()
    named = [(i, name, float(v)) for i, (name, v) in enumerate(zip(_slot_names(model, rows), importances, strict=True))]
    return rows.sparkSession.createDataFrame(named, "slot int, feature string, importance double")


def top_importances(importances: DataFrame, n: int = 15) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(n)
