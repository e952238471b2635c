"""Training rows over many tasks."""

from pyspark.sql import functions as F

from ledgerline.operators import layout as L, models as M
from ledgerline.plans import queries as Q
from ledgerline.session import fresh_dir
from ledgerline.sources.files import store
from tests.helpers import values


def one_file(spark, rows):
    table = spark.range(rows).select("id", (F.col("id") % 2).cast("int").alias("y")).coalesce(1)
    return store(table, fresh_dir(spark, "one-file"))


def test_one_file_is_spread_evenly_and_repeatably(spark):
    table = one_file(spark, 45_000)
    assert table.rdd.getNumPartitions() == 1
    spread = L.spread(table)
    sizes = spread.rdd.glom().map(len).collect()
    assert len(sizes) == 3 and max(sizes) < 15_100
    order = spread.select("id", F.spark_partition_id()).collect()
    assert order == spread.select("id", F.spark_partition_id()).collect()
    assert sorted(r["id"] for r in order) == list(range(45_000))


def test_equal_rows_are_spread_too(spark):
    table = store(spark.range(45_000).select(F.lit(1).alias("k")).coalesce(1), fresh_dir(spark, "equal"))
    assert L.spread(table).rdd.glom().map(len).collect() == [15_000] * 3


def test_tasks_follow_the_rows(spark):
    table = one_file(spark, 1_000)
    cores = spark.sparkContext.defaultParallelism
    assert L.spread(table) is table
    assert L.spread(table, rows_per_task=1).rdd.getNumPartitions() == 2 * cores
    assert L.spread(table, rows_per_task=1, most_per_task=10).rdd.getNumPartitions() == 100
    assert values(L.spread(table, rows_per_task=1)) == values(table)


def test_models_are_fitted_on_spread_rows(spark, monkeypatch):
    tasks = []
    monkeypatch.setattr(M, "fit", lambda candidate, train: tasks.append(train.rdd.getNumPartitions()))
    Q.fitted("GBT", one_file(spark, 30_000))
    assert tasks == [2]
