import pytest
from tests.helpers import values
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import evaluation as E, features as X, models as M, sampling
from ledgerline.plans import training
from ledgerline.session import fresh_dir

QUICK = {"RandomForest": {"numTrees": 10, "maxDepth": 4}, "GBT": {"maxIter": 4, "maxDepth": 3}}


@pytest.fixture(scope="module")
def parts(clients):
    train, test = sampling.random_split(training.model_table(clients, "row_id"), 0.8, "row_id")
    return train.persist(), test.persist()


@pytest.fixture(scope="module")
def forest(parts):
    return M.fit(M.CANDIDATES["RandomForest"], parts[0], **QUICK["RandomForest"])


@pytest.fixture(scope="module")
def scored(forest, parts):
    return M.predict(forest, parts[1]).persist()


def test_one_hot_keeps_a_slot_per_label(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("a", 4)], "k string, n int")
    prepared = Pipeline(stages=X.preparation(["k"], ["n"])).fit(df).transform(df)
    assert prepared.first()[X.hot_column("k")].size == 3
    assert X.feature_names(prepared) == ["n", "k=a", "k=b", "k=c"]


def test_names_cover_the_whole_vector(parts):
    prepared = Pipeline(stages=X.preparation()).fit(parts[0]).transform(parts[0])
    names = X.feature_names(prepared)
    assert len(names) == len(set(names)) == prepared.first()[X.FEATURES].size
    assert names[:10] == list(schemas.NUMERIC_FEATURES)
    assert not any(n.startswith(("month", "duration")) for n in names)


def test_class_weights_balance_the_classes(parts):
    weighted = X.with_class_weight(parts[0])
    sums = dict(values(weighted.groupBy("y").agg(F.sum("weight"))))
    assert sums[1] == pytest.approx(sums[0])
    assert X.with_unit_weight(parts[0]).agg(F.avg("weight")).first()[0] == 1.0


def test_auc_matches_the_evaluator(scored):
    evaluator = BinaryClassificationEvaluator(labelCol="y", numBins=0)
    assert E.auc(scored).first()[0] == pytest.approx(evaluator.evaluate(scored))


def test_weighted_metrics_match_the_evaluator(scored):
    row = E.weighted_metrics(scored).first()
    for metric, name in [("f1", "f1"), ("weightedPrecision", "weighted_precision"),
                         ("weightedRecall", "weighted_recall")]:
        evaluator = MulticlassClassificationEvaluator(labelCol="y", metricName=metric)
        assert row[name] == pytest.approx(evaluator.evaluate(scored))
    for level in (0, 1):
        metrics = E.class_metrics(scored, level).first()
        for metric, name in [("precisionByLabel", "precision"), ("recallByLabel", "recall")]:
            evaluator = MulticlassClassificationEvaluator(labelCol="y", metricName=metric, metricLabel=level)
            assert metrics[name] == pytest.approx(evaluator.evaluate(scored))


def test_weighted_recall_is_accuracy(scored):
    accuracy = scored.agg(F.avg((F.col("y") == F.col("prediction")).cast("int"))).first()[0]
    assert E.metrics(scored).first()["weighted_recall"] == pytest.approx(accuracy)


def test_auc_of_ties_and_single_class(spark):
    ties = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.9, 1), (0.1, 0)], "score double, y int")
    assert E.auc(ties).first()[0] == pytest.approx(0.875)
    single = spark.createDataFrame([(0.5, 1), (0.2, 1)], "score double, y int")
    assert E.auc(single).first()[0] is None


def test_no_predicted_positives(spark):
    df = spark.createDataFrame([(0.0, 0), (0.0, 1)], "prediction double, y int")
    assert tuple(E.class_metrics(df).first()) == (0.0, 0.0)
    assert E.weighted_metrics(df).first()["f1"] == pytest.approx(1 / 3)


def test_models_find_the_signal(parts, scored):
    assert E.metrics(scored).first()["roc_auc"] > 0.65
    regression = M.predict(M.fit(M.CANDIDATES["LogReg"], parts[0]), parts[1])
    # Only positives with an earlier success can be told apart by the features.
    positives = parts[1].where("y = 1")
    reachable = positives.where("poutcome = 'success'").count() / positives.count()
    assert E.metrics(regression).first()["positive_recall"] > 0.9 * reachable


def test_importance_names_and_order(forest, scored):
    top = M.feature_importance(forest, scored).collect()
    weights = [r["importance"] for r in top]
    assert len(top) == 15 and weights == sorted(weights, reverse=True)
    assert any(r["feature"].startswith("poutcome=") for r in top[:3])
    everything = M.feature_importance(forest, scored, top=None)
    assert everything.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_reload_gives_the_same_predictions(spark, forest, parts, scored):
    path = fresh_dir(spark, "forest")
    M.save(forest, path)
    M.save(forest, path)
    again = M.predict(M.load(path), parts[1])
    assert values(again, "row_id", "prediction", "score") == values(scored, "row_id", "prediction", "score")
    assert {"prediction", "probability", "rawPrediction"} <= set(again.columns)


def test_grids():
    sizes = {n: len(M.param_grid(c.classifier(), c.grid)) for n, c in M.CANDIDATES.items()}
    assert sizes == {"LogReg": 6, "RandomForest": 4, "GBT": 4}


def test_baseline_parameters():
    forest = M.CANDIDATES["RandomForest"].classifier()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 8, 42)
    boosted = M.CANDIDATES["GBT"].classifier()
    assert (boosted.getMaxIter(), boosted.getMaxDepth()) == (80, 5)
    regression = M.CANDIDATES["LogReg"].classifier()
    assert (regression.getMaxIter(), regression.getWeightCol()) == (50, "weight")


def test_training_job(spark, clients):
    base = fresh_dir(spark, "training")
    grids = {"LogReg": {"regParam": (0.1,)}, "RandomForest": {"numTrees": (5,)}}
    candidates = {n: M.CANDIDATES[n] for n in grids}
    table = training.train_and_select(
        clients, "row_id", f"{base}/model", f"{base}/report", candidates, grids=grids)
    rows = {r["model"]: r for r in table.collect()}
    assert set(rows) == set(grids)
    best = max(rows.values(), key=lambda r: r["roc_auc"])
    assert best["is_best"] and sum(r["is_best"] for r in rows.values()) == 1
    assert spark.read.json(f"{base}/report/best").first()["model"] == best["model"]
    model = M.load(f"{base}/model")
    assert M.predict(model, training.model_table(clients, "row_id").limit(5)).count() == 5


def plain_curve(rows):
    points = []
    for threshold in sorted({s for s, _ in rows}):
        tp = sum(y for s, y in rows if s >= threshold)
        called = sum(s >= threshold for s, _ in rows)
        positives = sum(y for _, y in rows)
        points.append((threshold, tp, called - tp, positives - tp, tp / called, tp / positives))
    return points


def scores(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "k int, score double, y int")


def test_precision_recall_curve(spark):
    import random
    rng = random.Random(1)
    rows = [(rng.choice([0.1, 0.2, 0.25, 0.5, 0.9, round(rng.random(), 3)]), int(rng.random() < 0.3)) for _ in range(400)]
    odd = scores(spark, [*rows, (None, 1), (float("nan"), 1), (0.3, None)])
    curve = E.precision_recall(odd)
    got = sorted(tuple(r)[:6] for r in curve.collect())
    assert got == [pytest.approx(p) for p in plain_curve(rows)]
    points = sorted(plain_curve(rows), reverse=True)
    area, before = 0.0, 0.0
    for p in points:
        area, before = area + (p[5] - before) * p[4], p[5]
    assert E.average_precision(curve).first()[0] == pytest.approx(area)
    for call, missed in ((1, 1), (1, 8), (3, 1)):
        best = min(points, key=lambda p: (call * p[2] + missed * p[3], -p[0]))
        assert tuple(E.best_threshold(curve, call, missed).first())[:4] == (call * best[2] + missed * best[3], *best[:3])
    fits = [p for p in points if p[1] + p[2] <= 100]
    assert E.threshold_at_capacity(curve, 100).first()["threshold"] == min(p[0] for p in fits)


def test_curve_of_one_class_and_of_nothing(spark):
    negatives = E.precision_recall(scores(spark, [(0.1, 0), (0.2, 0)]))
    assert [(r["precision"], r["recall"]) for r in negatives.collect()] == [(0.0, None)] * 2
    empty = E.precision_recall(scores(spark, [(0.1, 0)]).limit(0))
    assert empty.count() == 0 and E.best_threshold(empty, 1, 1).first()["threshold"] is None
    ties = E.precision_recall(scores(spark, [(0.5, 1)] * 30 + [(0.5, 0)] * 10))
    assert [(r["tp"], r["fp"]) for r in ties.collect()] == [(30, 10)]
    assert E.threshold_at_capacity(ties, 39).first()["threshold"] is None


@pytest.mark.parametrize("count", [7, 10, 103, 1000])
def test_lift_parts_differ_by_one_row_at_most(spark, count):
    rows = [((i * 7919 % 50) / 50, int(i % 4 == 0)) for i in range(count)]
    got = sorted(map(tuple, E.lift_by_share(scores(spark, rows), "k").collect()))
    order = sorted(range(count), key=lambda i: (-rows[i][0], i))
    positives, at, captured = sum(y for _, y in rows), 0, 0
    for part in range(10):
        size = count // 10 + (part < count % 10)
        own, at = [rows[i] for i in order[at : at + size]], at + size
        if own:
            hits = sum(y for _, y in own)
            captured += hits
            assert got[part] == pytest.approx((
                part + 1, size, hits, hits / size, hits / size * count / positives, captured / positives,
                max(s for s, _ in own), min(s for s, _ in own)))
    assert len(got) == min(count, 10)


def test_lift_never_sorts_the_table_in_one_task(spark, small, monkeypatch):
    from ledgerline.operators import layout as L
    from ledgerline.plans import queries as Q
    result = E.lift_by_share(Q.rule_scores(Q.clients(spark, small)), "row_id")
    plan = L.plan_text(result, "simple")
    # Single-task exchanges hold one row per part or per partition, below the aggregate, never the rows.
    for line in plan.splitlines():
        if "Exchange SinglePartition" in line:
            below = plan[plan.index(line) + len(line):].lstrip().splitlines()[0]
            assert "HashAggregate" in below or "Project" in below, below
