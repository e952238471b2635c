import pytest
from tests.helpers import values
from pyspark.sql import functions as F

from ledgerline.operators import sampling


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(5000).select(
        F.col("id"), F.when(F.col("id") % 9 == 0, 1).otherwise(0).alias("y"))


def test_exact_sample_size(people):
    for n in (0, 1, 800, 5000, 9999):
        sample = sampling.exact_sample(people, n, "id")
        assert sample.count() == sample.distinct().count() == min(n, 5000)


def test_sample_depends_on_keys_and_seed_only(people):
    first = values(sampling.exact_sample(people, 100, "id"))
    assert first == values(sampling.exact_sample(people.repartition(13), 100, "id"))
    assert first != values(sampling.exact_sample(people, 100, "id", seed=7))
    assert set(first) < set(values(sampling.exact_sample(people, 200, "id")))


def test_random_split(people):
    train, test = sampling.random_split(people, 0.8, "id")
    assert train.count() + test.count() == 5000
    assert train.intersect(test).count() == 0
    assert 3800 < train.count() < 4200
    again, _ = sampling.random_split(people.repartition(5), 0.8, "id")
    assert values(train) == values(again)


def test_stratified_split_is_exact_per_class(people):
    train, test = sampling.stratified_split(people, 0.8, "id", "y", (0, 1))
    totals = dict(values(people.groupBy("y").count()))
    kept = dict(values(train.groupBy("y").count()))
    assert kept == {y: int(0.8 * n + 0.5) for y, n in totals.items()}
    assert values(train.unionByName(test)) == values(people)


def test_stratified_split_keeps_unlisted_labels(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None), (4, 5)], "id int, y int")
    train, test = sampling.stratified_split(df, 0.5, "id", "y", (0, 1))
    assert train.count() + test.count() == 4
    assert {3, 4} <= {r["id"] for r in test.collect()}


def test_stratified_split_of_a_hot_class(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2900, 0).otherwise(1).alias("y"))
    train, _ = sampling.stratified_split(df, 0.8, "id", "y", (0, 1))
    assert dict(values(train.groupBy("y").count())) == {0: 2320, 1: 80}


def test_fraction_sample_needs_no_shuffle(people):
    sample = sampling.fraction_sample(people, 0.1, "id")
    assert 400 < sample.count() < 600
    assert "Exchange" not in sample._jdf.queryExecution().executedPlan().toString()


def test_cut_offs_are_stored_once_for_both_parts(spark, clients):
    from ledgerline.operators import layout as L
    train, test = sampling.stratified_split(clients.select("row_id", "y"), 0.8, "row_id", "y", (0, 1))
    for part in (train, test):
        plan = L.plan_text(part)
        assert "cuts-" in plan and "Window" not in plan and "Aggregate" not in plan


def test_cut_in_the_second_level_of_cells(spark, monkeypatch):
    """With one-digit cells the first level leaves many rows, and the second still finds the exact cut."""
    monkeypatch.setattr(sampling, "CELL_DIGITS", 1)
    df = spark.range(3000).withColumnRenamed("id", "k")
    whole = [r["k"] for r in df.orderBy(sampling.key_hash("k", 42), "k").collect()]
    for n in (0, 1, 57, 2999, 3000, 5000):
        assert {r["k"] for r in sampling.exact_sample(df, n, "k").collect()} == set(whole[:n])
