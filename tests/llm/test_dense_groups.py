"""Large groups of near copies: exact counts from few rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import embedding_dedup, shingle_join
from ledgerline.llm.common import ship


def brute_links(x):
    unit = embedding_dedup.unit(np.asarray(x, dtype=float))
    links = unit @ unit.T >= 0.9
    np.fill_diagonal(links, False)
    return links


@pytest.mark.parametrize("tile", [1024, 50])
def test_dense_cluster_is_counted_once_over_all_tables(spark, monkeypatch, tile):
    """A cluster in which every two link, copies in it, and a lone pair."""
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rng = np.random.default_rng(11)
    centre, other = rng.normal(size=(2, 32))
    dense = centre + 0.02 * rng.normal(size=(400, 32))
    x = np.concatenate([dense, dense[:25], [other, other + 0.01 * rng.normal(size=32)], rng.normal(size=(50, 32))])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicate_vectors(df).collect()}
    links = brute_links(x)
    assert [got[i]["n_links"] for i in range(len(x))] == links.sum(axis=1).tolist()
    assert [got[i]["component_id"] for i in range(427)] == [0] * 425 + [425] * 2
    assert [got[i]["component_id"] for i in range(427, len(x))] == list(range(427, len(x)))


def test_dense_cluster_makes_rows_in_proportion(spark):
    ship(spark)
    rng = np.random.default_rng(12)
    x = rng.normal(size=32) + 0.02 * rng.normal(size=(600, 32))
    classes = spark.createDataFrame([(i, 1, v) for i, v in enumerate(x.tolist())], "id int, copies bigint, vector array<double>")
    hashed = embedding_dedup.with_buckets(classes, 32, 1, 12, 2).persist()
    links = embedding_dedup._links(hashed, 32, 12, 0.9).persist()
    assert links.where("n IS NOT NULL").agg(F.sum("n")).first()[0] == 600 * 599
    assert links.count() <= 2 * 12 * 2 * 600
    hashed.unpersist()
    links.unpersist()


def test_first_shared_bucket():
    """Rows 0 and 1 share table 0, 1 and 2 only table 1, 0 and 2 two buckets of table 1."""
    buckets = np.array([[[5, 6], [8, 9]], [[6, 7], [1, 2]], [[0, 3], [9, 8]]])
    buckets[1, 1] = [9, 4]
    a, b = np.array([0, 0, 1]), np.array([1, 2, 2])
    found = {(t, n): embedding_dedup.first_shared(a, b, buckets, t, n).tolist() for t, n in [(0, 6), (1, 8), (1, 9)]}
    assert found[0, 6][0] and found[1, 8] == [False, True, True] and found[1, 9] == [False, False, True]


def test_spanning_joins_what_pairs_join():
    rng = np.random.default_rng(13)
    for rows, count in [(1, 0), (7, 3), (300, 150), (300, 900)]:
        a, b = rng.integers(0, rows, size=(2, count))
        label = list(range(rows))
        for _ in range(rows):
            for i, j in zip(a, b):
                label[i] = label[j] = min(label[i], label[j])
        assert embedding_dedup.spanning(rows, a, b).tolist() == label
    line = np.arange(999)
    assert not embedding_dedup.spanning(1000, line, line + 1).any()


def test_hot_leader_is_dealt_over_salts(spark):
    """3,000 sets under one leader whose groups are joined, and leaders whose groups are not."""
    hot = spark.range(3000).crossJoin(spark.range(3).withColumnRenamed("id", "h")).select(
        "h", F.lit(-1).cast("long").alias("lead"), F.col("id").alias("s"), F.col("id").alias("c"))
    lone = spark.range(100, 150).select(
        "id", F.col("id").alias("lead"), F.explode(F.array(F.col("id"), F.col("id") + 10_000)).alias("s"), F.col("id").alias("c"))
    merged = shingle_join._merged(hot.unionByName(lone.withColumnRenamed("id", "h")))
    found = {(r.h, r.joined): r.n for r in merged.groupBy("h", "joined").agg(F.countDistinct("s").alias("n")).collect()}
    assert found == {(-1, True): 3000} | {(h, False): 2 for h in range(100, 150)}
    assert merged.count() == 3000 + 100
    assert "[lead#" in (plan := merged._jdf.queryExecution().executedPlan().toString()) and "_salt#" in plan
