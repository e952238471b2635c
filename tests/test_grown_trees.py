"""Trees grown from histograms of binned rows, against Spark's own."""

import dataclasses
import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerline.operators import evaluation as E, features as X, grown_trees as G, models as M
from ledgerline.session import fresh_dir

CATEGORICAL, NUMERIC = ["job", "plan"], ["age", "debt"]


@pytest.fixture(scope="module")
def table(spark):
    """6,000 rows, numbers with more and with fewer values than bins, labels of noise and signal."""
    rows = spark.range(6_000).select(
        F.col("id").alias("row_id"), F.concat(F.lit("j"), F.pmod(F.xxhash64("id"), F.lit(5))).alias("job"),
        F.concat(F.lit("p"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3))).alias("plan"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(2_000)).cast("int").alias("age"),
        F.pmod(F.xxhash64("id", F.lit(3)), F.lit(9)).cast("int").alias("debt"))
    noise = F.pmod(F.xxhash64("row_id", F.lit(4)), F.lit(1_000))
    strength = F.col("age") / 4 + 40 * F.col("debt") + F.when(F.col("job") == "j2", 300).otherwise(0)
    return rows.withColumn("y", (noise < strength / 2).cast("int")).repartition(3).persist()


@pytest.fixture(scope="module")
def preparation(table):
    return Pipeline(stages=X.preparation(CATEGORICAL, NUMERIC)).fit(table)


def probabilities(model, df):
    rows = model.transform(df).select("row_id", vector_to_array("probability")[1].alias("p")).collect()
    return dict(rows)


def equal(ours, theirs, df):
    mine, own = probabilities(ours, df), probabilities(theirs, df)
    assert mine.keys() == own.keys() and len({round(p, 9) for p in own.values()}) > 3
    assert max(abs(mine[k] - own[k]) for k in own) < 1e-9


def test_boosting_equals_sparks(table, preparation, monkeypatch):
    monkeypatch.setattr(G, "ANCHOR", 2)
    monkeypatch.setattr(G, "CHUNK", 700)
    classifier = M.CANDIDATES["GBT"].classifier(maxIter=5, maxDepth=4)
    ours, theirs = G.boost(classifier, preparation, table), classifier.fit(preparation.transform(table))
    equal(ours, theirs, preparation.transform(table))
    assert ours.uid == theirs.uid and ours.getNumTrees == 5 and ours.treeWeights == theirs.treeWeights
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-6)


def test_a_tree_of_all_rows_equals_sparks(table, preparation):
    classifier = M.CANDIDATES["RandomForest"].classifier(
        numTrees=1, maxDepth=6, bootstrap=False, featureSubsetStrategy="all")
    ours, theirs = G.grow_forest(classifier, preparation, table), classifier.fit(preparation.transform(table))
    equal(ours, theirs, preparation.transform(table))
    assert ours.numClasses == 2 and ours.totalNumNodes == theirs.totalNumNodes


def test_a_forest_is_as_good_as_sparks_and_repeatable(table, preparation):
    classifier, rows = M.CANDIDATES["RandomForest"].classifier(numTrees=30), preparation.transform(table)
    ours, theirs = G.grow_forest(classifier, preparation, table), classifier.fit(rows)
    assert len({t.toDebugString for t in ours.trees}) == 30
    areas = [E.auc(E.with_score(m.transform(rows))).first()[0] for m in (ours, theirs)]
    assert areas[0] == pytest.approx(areas[1], abs=0.02)
    assert 0.8 < ours.totalNumNodes / theirs.totalNumNodes < 1.25
    assert probabilities(G.grow_forest(classifier, preparation, table), rows) == probabilities(ours, rows)


def test_bootstrap_draws_are_poisson():
    drawn = G.times_drawn([1, 2, 3], 200_000, 1.0)
    shares = [float((drawn == k).mean()) for k in range(5)]
    assert shares == pytest.approx([math.exp(-1) / math.factorial(k) for k in range(5)], abs=0.005)
    assert (drawn == G.times_drawn([1, 2, 3], 200_000, 1.0)).all()
    assert (drawn != G.times_drawn([1, 2, 4], 200_000, 1.0)).any()


@pytest.mark.parametrize("name", ["RandomForest", "GBT"])
def test_many_rows_are_fitted_by_growing(spark, clients, monkeypatch, name):
    from ledgerline.plans.training import model_table
    rows = model_table(clients, "row_id").limit(2_000).persist()
    many = dataclasses.replace(M.CANDIDATES[name], grow_above=1_999)
    monkeypatch.setattr(many.make, "fit", None)  # Spark's fit keeps no pace with the rows
    model = M.fit(many, rows, maxDepth=3, **({"maxIter": 2} if name == "GBT" else {"numTrees": 5}))
    path = fresh_dir(spark, "grown")
    M.save(model, path)
    scored = M.predict(M.load(path), rows).persist()
    assert E.auc(scored).first()[0] > 0.6
    top = M.feature_importance(model, scored, top=None)
    assert top.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_other_settings_and_few_rows_stay_with_spark():
    assert not G.can_grow(M.CANDIDATES["GBT"].classifier(subsamplingRate=0.5), {"subsamplingRate"})
    assert not G.can_grow(M.CANDIDATES["GBT"].classifier(maxDepth=20), {"maxDepth"})
    assert M.CANDIDATES["GBT"].grow_above == 500_000


def test_labels_other_than_two_are_refused(table, preparation):
    odd = table.withColumn("y", F.when(F.col("row_id") == 7, 2).otherwise(F.col("y")))
    with pytest.raises(Exception, match="labels other than 0 and 1"):
        G.boost(M.CANDIDATES["GBT"].classifier(maxIter=1), preparation, odd)
