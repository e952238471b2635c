"""Classifiers, their grids, tuning, importances and persistence."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from ledgerline import schemas
from ledgerline.operators import evaluation, features, grown_trees, layout
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.files import literal_table, store

# Baseline parameters and tuning grids.
LR_BASE = {"maxIter": 50}
RF_BASE = {"numTrees": 100, "maxDepth": 8}
GBT_BASE = {"maxIter": 80, "maxDepth": 5}
LR_GRID = {"regParam": (0.0, 0.01, 0.1), "elasticNetParam": (0.0, 0.5)}
RF_GRID = {"numTrees": (50, 150), "maxDepth": (6, 10)}
GBT_GRID = {"maxDepth": (4, 6), "maxIter": (50, 100)}
FOLDS = 3
PARALLELISM = 2


@dataclass(frozen=True)
class Candidate:
    """A kind of classifier with its baseline parameters and tuning grid."""

    name: str
    make: Callable
    base: Mapping[str, object]
    grid: Mapping[str, tuple]
    weighted: bool = False
    seeded: bool = True
    rows_per_task: int = 15_000
    grow: Callable | None = None  # fits the same model on more rows than ``grow_above``
    grow_above: int = 500_000

    def classifier(self, label: str = "y", **overrides):
        params = {**self.base, **overrides, "labelCol": label, "featuresCol": features.FEATURES}
        if self.weighted:
            params["weightCol"] = "weight"
        if self.seeded:
            params["seed"] = schemas.SEED
        return self.make(**params)


CANDIDATES = {
    c.name: c
    for c in (
        Candidate("LogReg", LogisticRegression, LR_BASE, LR_GRID, weighted=True, seeded=False,
                  rows_per_task=250_000),  # a pass over a row is short
        Candidate("RandomForest", RandomForestClassifier, RF_BASE, RF_GRID, grow=grown_trees.grow_forest),
        Candidate("GBT", GBTClassifier, GBT_BASE, GBT_GRID, grow=grown_trees.boost),
    )
}


def training_input(candidate: Candidate, train: DataFrame, label: str = "y") -> DataFrame:
    return features.with_class_weight(train, label) if candidate.weighted else train


def fit(candidate: Candidate, train: DataFrame, label: str = "y", **overrides) -> PipelineModel:
    """Preparation and classifier fitted as one pipeline.

    A checkpoint folder lets boosting cut its lineage every few rounds. On many
    rows trees grow from histograms of binned rows, by the same rules.
    """
    ensure_checkpoint_dir(train.sparkSession)
    classifier, rows = candidate.classifier(label, **overrides), training_input(candidate, train, label)
    if candidate.grow and grown_trees.can_grow(classifier, overrides) and rows.count() > candidate.grow_above:
        prepared = Pipeline(stages=features.preparation()).fit(rows)
        return PipelineModel([*prepared.stages, candidate.grow(classifier, prepared, rows)])
    return Pipeline(stages=[*features.preparation(), classifier]).fit(rows)


def param_grid(classifier, grid: Mapping[str, tuple]) -> list:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(classifier.getParam(name), list(values))
    return builder.build()


def tune(
    candidate: Candidate, train: DataFrame, label: str = "y",
    grid: Mapping[str, tuple] | None = None, num_folds: int = FOLDS,
    parallelism: int = PARALLELISM,
) -> CrossValidatorModel:
    """Cross-validated grid search on ROC-AUC, preparation refitted per fold.

    Folds are drawn per partition from a seed, so ``train`` should be a stored
    table: its partitions hold the same rows whenever one is read again. They
    are the folds of ``CrossValidator``, which would refit the preparation for
    every grid point; here those of a fold share it.
    """
    ensure_checkpoint_dir(train.sparkSession)
    classifier = candidate.classifier(label)
    points = param_grid(classifier, grid or candidate.grid)
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    with layout.cached(layout.spread(train, candidate.rows_per_task)) as held, ThreadPool(parallelism) as pool:
        rows = training_input(candidate, held, label)
        drawn = rows.withColumn("_fold", F.rand(schemas.SEED))
        metrics = []
        for fold in range(num_folds):
            chosen = (F.col("_fold") >= fold / num_folds) & (F.col("_fold") < (fold + 1) / num_folds)
            with layout.cached(drawn.where(~chosen)) as fitting, layout.cached(drawn.where(chosen)) as judging:
                prepared = Pipeline(stages=features.preparation()).fit(fitting)
                known, unseen = prepared.transform(fitting), prepared.transform(judging)
                score = inheritable_thread_target(train.sparkSession)(
                    lambda point: evaluator.evaluate(classifier.fit(known, point).transform(unseen)))
                metrics.append(pool.map(score, points, chunksize=1))
        means = [sum(of_point) / num_folds for of_point in zip(*metrics)]
        best = points[means.index(max(means))]
        model = Pipeline(stages=[*features.preparation(), classifier.copy(best)]).fit(rows)
    tuned = CrossValidatorModel(model, means)
    tuned.set(tuned.estimatorParamMaps, points)
    return tuned


def grid_table(tuned: CrossValidatorModel, df: DataFrame) -> DataFrame:
    """Mean metric of every grid point."""
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda i: i[0].name)), float(m))
        for point, m in zip(tuned.getEstimatorParamMaps(), tuned.avgMetrics)
    ]
    return literal_table(df.sparkSession, rows, ["params", "roc_auc"])


def predict(model: PipelineModel | CrossValidatorModel, df: DataFrame) -> DataFrame:
    """Rows with prediction, probability and a plain positive-class score."""
    return evaluation.with_score(model.transform(df))


def stored_scores(
    model: PipelineModel | CrossValidatorModel, df: DataFrame, path: str, *keep: str, label: str = "y"
) -> DataFrame:
    """Score a table once and keep the columns that metrics need.

    Every metric is a pass over its input; from the stored scores none of them
    runs the model again.
    """
    return store(predict(model, df).select(*keep, label, "prediction", "score"), path)


def comparison(scored: Mapping[str, DataFrame], label: str = "y") -> DataFrame:
    """One metrics row per model."""
    rows = [
        evaluation.metrics(frame, label=label).select(F.lit(name).alias("model"), "*")
        for name, frame in scored.items()
    ]
    table = rows[0]
    for row in rows[1:]:
        table = table.unionByName(row)
    return table


def best_of(table: DataFrame) -> DataFrame:
    """The row with the highest ROC-AUC."""
    return table.orderBy(F.desc("roc_auc"), "model").limit(1)


def feature_importance(model: PipelineModel, prepared: DataFrame, top: int | None = 15) -> DataFrame:
    """Importances of a tree model under the names of the vector's slots."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(features.feature_names(prepared), weights, strict=True)]
    table = literal_table(prepared.sparkSession, rows, ["feature", "importance"])
    ordered = table.orderBy(F.desc("importance"), "feature")
    return ordered if top is None else ordered.limit(top)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
