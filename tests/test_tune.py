"""The grid search against Spark's CrossValidator."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator

from ledgerline import schemas
from ledgerline.operators import features as X, models as M
from ledgerline.plans import queries as Q


def test_search_equals_cross_validator_with_one_preparation_a_fold(spark, clients, monkeypatch):
    train, _ = Q.split_model_table(clients)
    candidate, grid = M.CANDIDATES["LogReg"], {"regParam": (0.1, 10.0)}
    classifier = candidate.classifier()
    expected = CrossValidator(
        estimator=Pipeline(stages=[*X.preparation(), classifier]), estimatorParamMaps=M.param_grid(classifier, grid),
        evaluator=BinaryClassificationEvaluator(labelCol="y"), numFolds=2, seed=schemas.SEED,
    ).fit(M.training_input(candidate, train))
    prepared, preparation = [], X.preparation
    monkeypatch.setattr(X, "preparation", lambda: prepared.append(1) or preparation())
    tuned = M.tune(candidate, train, grid=grid, num_folds=2)
    assert len(prepared) == 3
    assert tuned.avgMetrics == pytest.approx(expected.avgMetrics, abs=1e-9)
    assert M.grid_table(tuned, train).count() == 2
    ours, theirs = tuned.bestModel.stages[-1], expected.bestModel.stages[-1]
    assert ours.coefficients.toArray() == pytest.approx(theirs.coefficients.toArray(), abs=1e-6)
