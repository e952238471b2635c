"""Degenerate inputs give NULL or a defined result instead of an error."""

import pytest

from ledgerline.functions import columns as C
from ledgerline.operators import distributions as D, evaluation as E, features as X, hypothesis as H, sampling
from ledgerline.session import fresh_dir, stream_session
from ledgerline.sources import files


def test_auc_leaves_out_unknown_scores(spark):
    rows = [(0.9, 1), (0.1, 0), (None, 1), (None, 0), (float("nan"), 0), (0.5, None)]
    scored = spark.createDataFrame(rows, "score double, y int")
    assert E.auc(scored).first()["roc_auc"] == 1.0


def test_median_leaves_out_nan(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "v double")
    assert D.median(df, "v").first()["median"] == 2.0


def test_tests_without_variance_or_level(spark):
    flat = spark.createDataFrame([(1.0, 0), (1.0, 0), (1.0, 1), (1.0, 1)], "v double, y int")
    assert H.welch(flat, "v", "y").first()["t"] is None
    one = spark.createDataFrame([("a", 0), ("b", 0)], "k string, y int")
    assert H.chi_squared(one, "k", "y", (0, 1)).first()["chi2"] == 0.0


def test_density_without_spread(spark):
    df = spark.createDataFrame([(2.0,)] * 3, "v double")
    assert all(r["density"] is None for r in D.density(df, "v", 3).collect())


def test_weights_and_metrics_without_rows_or_positives(spark):
    none = spark.createDataFrame([(0,), (0,)], "y int")
    assert [r["weight"] for r in X.with_class_weight(none).collect()] == [1.0, 1.0]
    empty = spark.createDataFrame([], "y int, prediction double")
    assert E.weighted_metrics(empty).first()["f1"] is None


def test_whole_share_keeps_every_row(spark):
    df = spark.range(1000)
    assert sampling.fraction_sample(df, 1.0, "id").count() == 1000
    train, test = sampling.random_split(df, 1.0, "id")
    assert (train.count(), test.count()) == (1000, 0)
    with pytest.raises(ValueError):
        C.hash_point(1.5)


def test_csv_with_other_column_order_is_refused(spark):
    path = fresh_dir(spark, "reordered")
    spark.createDataFrame([("x", 30, 5)], "job string, age int, balance int").write.option("header", True).csv(path)
    with pytest.raises(Exception, match="(?i)header"):
        files.read_campaign_csv(spark, path).collect()


def test_state_partitions_follow_the_setting(spark):
    assert stream_session(spark).conf.get("spark.sql.shuffle.partitions") == spark.conf.get(
        "spark.sql.shuffle.partitions")
    assert stream_session(spark, 7).conf.get("spark.sql.shuffle.partitions") == "7"
