"""The training job: split, tune every candidate, compare, keep the best."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ledgerline import schemas
from ledgerline.operators import cleaning, models, sampling
from ledgerline.session import fresh_dir
from ledgerline.sources.files import store


def model_table(clients: DataFrame, key: str) -> DataFrame:
    """Key, label and feature columns with NULL categories filled."""
    columns = [key, "y", *schemas.CATEGORICAL_FEATURES, *schemas.NUMERIC_FEATURES]
    return cleaning.fill_missing(clients.select(*columns))


def stored_split(clients: DataFrame, key: str, fraction: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Training and held-out tables in the shared folder, read many times by the fits."""
    folder = fresh_dir(clients.sparkSession, "split")
    train, test = sampling.random_split(model_table(clients, key), fraction, key)
    return store(train, f"{folder}/train"), store(test, f"{folder}/test")


def train_and_select(
    clients: DataFrame, key: str, model_path: str, report_path: str,
    candidates: Mapping[str, models.Candidate] = models.CANDIDATES,
    fraction: float = 0.8, grids: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """Tune, evaluate on the held-out part, save the best pipeline and a JSON report.

    Returns the comparison table with the chosen model marked.
    """
    spark = clients.sparkSession
    train, test = stored_split(clients, key, fraction)
    scores = fresh_dir(spark, "scores")
    tuned, scored = {}, {}
    for name, candidate in candidates.items():
        tuned[name] = models.tune(candidate, train, grid=(grids or {}).get(name)).bestModel
        scored[name] = models.stored_scores(tuned[name], test, f"{scores}/{name}")
    # One row per model; stored so that the metrics are computed once.
    models.comparison(scored).write.mode("overwrite").json(f"{report_path}/all")
    table = spark.read.json(f"{report_path}/all")
    best = models.best_of(table)
    best.write.mode("overwrite").json(f"{report_path}/best")
    name = best.first()["model"]
    models.save(tuned[name], model_path)
    return table.withColumn("is_best", F.col("model") == name)
