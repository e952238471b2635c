"""Physical plans: what is shuffled, pushed down, pruned and broadcast."""

import re

import pytest
from tests.helpers import values
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import joins as J, layout as L, segments as S
from ledgerline.plans import reports
from ledgerline.session import fresh_dir
from ledgerline.sources import files, warehouse as W

SECTORS = (("automobile", "industry"), ("building", "industry"), ("household", "other"))


@pytest.fixture(scope="module")
def stored(spark, clients):
    path = fresh_dir(spark, "plan-warehouse")
    W.write_warehouse(clients, path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def sectors(spark):
    return files.literal_table(spark, SECTORS, ["job", "sector"])


def exchanges(df):
    return len(re.findall(r"^\(\d+\) Exchange", L.plan_text(df), re.M))


def test_report_reads_its_columns_and_pushes_its_filter(stored):
    plan = L.plan_text(reports.REPORTS["job"].run(stored))
    assert "PushedFilters: [IsNotNull(job)]" in plan
    assert "ReadSchema: struct<job:string,y:int>" in plan
    assert "partial_avg" in plan or "partial_count" in plan


def test_month_filter_prunes_folders(stored):
    plan = L.plan_text(stored.where(F.col("month") == "may").select("age"))
    assert re.search(r"PartitionFilters: \[.*month.*may", plan)
    assert "ReadSchema: struct<age:int>" in plan


def test_one_file_per_month_when_small(stored):
    assert len(stored.inputFiles()) == stored.select("month").distinct().count()


def test_rebalance_hint_in_write_plan(clients):
    assert "REBALANCE_PARTITIONS_BY_COL" in L.plan_text(clients.hint("rebalance", "month"))


def test_join_strategies_agree(clients, sectors):
    fact = clients.select("row_id", "job", "balance")
    default = J.lookup_join(fact, sectors, "job")
    shuffled = J.shuffle_join(fact, sectors, "job", ["row_id"])
    broadcast = J.broadcast_join(fact, sectors, "job")
    with pytest.raises(ValueError, match="shuffle_join"):
        J.broadcast_join(fact, sectors, "job", max_rows=2)
    assert "SortMergeJoin" in L.plan_text(shuffled) and exchanges(shuffled) == 2
    assert "BroadcastHashJoin" in L.plan_text(broadcast) and exchanges(broadcast) == 0
    assert "BroadcastHashJoin" in L.plan_text(default)
    columns = ("row_id", "job", "balance", "sector")
    expected = values(default, *columns)
    for joined in (shuffled, broadcast):
        assert values(joined, *columns) == expected
    assert all(r[1] for r in expected)


def test_salted_join_keeps_every_copy_of_a_hot_key(spark, sectors):
    hot = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, "other").otherwise("building").alias("job"))
    joined = J.shuffle_join(hot, sectors, "job", ["id"])
    assert joined.count() == joined.distinct().count() == 6000
    salts = hot.groupBy(F.pmod(F.xxhash64("id"), F.lit(16))).count().collect()
    assert max(r["count"] for r in salts) < 9000 / 16 * 1.3


def test_lookup_size_check(spark):
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    assert J.is_small(wide)
    assert not J.is_small(wide, max_rows=9)
    assert not J.is_small(wide, max_bytes=5000)


def test_repartition_by_key_saves_the_aggregate_exchange(clients):
    table = clients.select("row_id", "job", "balance")
    by_key = S.mean_by(L.repartition_by(table, 16, "job"), "job", "balance")
    salted = S.mean_by(L.repartition_by(table, 16, "job", ["row_id"]), "job", "balance")
    merged = S.mean_by(table.coalesce(2), "job", "balance")
    assert exchanges(by_key) == 1 and exchanges(salted) == 2 and exchanges(merged) == 1
    assert "Coalesce" in L.plan_text(merged)
    # Averages of integers are exact sums over counts, whatever the layout.
    assert values(by_key) == values(salted) == values(merged)


def test_salted_repartition_spreads_one_hot_key(spark):
    hot = spark.range(16000).select("id", F.lit("a").alias("job"))
    spread = L.repartition_by(hot, 16, "job", ["id"])
    sizes = spread.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 6 and max(r["count"] for r in sizes) < 6000


def test_cached_releases(clients):
    table = clients.select("job", "balance")
    with L.cached(table) as held:
        held.count()
        assert held.is_cached
    assert not table.is_cached


def test_preview_and_union(clients):
    rows = L.preview(clients.select("row_id", "job"), 5, "row_id")
    assert [r["row_id"] for r in rows] == sorted(r["row_id"] for r in rows) and len(rows) == 5
    assert L.times(clients, 3).count() == 3 * clients.count()


def test_calendar_and_schemas():
    assert len(schemas.MONTHS) == 12 and "duration" not in schemas.NUMERIC_FEATURES
    assert len(schemas.RAW_CAMPAIGN) == 17 and len(schemas.CLEAN_CAMPAIGN) == 21


@pytest.fixture(scope="module")
def buckets(spark, small):
    from ledgerline.plans import queries

    return queries.bucketed(spark, small)


def test_bucketed_tables_join_without_a_shuffle(spark, buckets):
    contacts, profiles = buckets
    joined = spark.table(contacts).join(spark.table(profiles).hint("merge"), "client_id")
    plan = L.plan_text(joined)
    assert exchanges(joined) == 0 and "SortMergeJoin" in plan and plan.count("Bucketed: true") == 2
    plain = spark.table(contacts).select("*").join(spark.table(profiles).hint("shuffle_hash"), "client_id")
    assert joined.count() == plain.count() == spark.table(contacts).count()


def test_one_client_reads_one_bucket_of_the_years_asked_for(spark, buckets):
    one = spark.table(buckets[0]).where("client_id = 7 and year = 1997")
    shown = "spark.sql.sources.bucketing.autoBucketedScan.enabled"  # else the plan prunes without saying so
    spark.conf.set(shown, "false")
    try:
        plan = L.plan_text(spark.table(buckets[0]).where("client_id = 7 and year = 1997"))
    finally:
        spark.conf.unset(shown)
    assert "SelectedBucketsCount: 1 out of 4" in plan
    assert re.search(r"PartitionFilters: \[.*year.*1997", plan)
    assert one.count() == spark.table(buckets[0]).where("client_id + 0 = 7 and year + 0 = 1997").count() > 0


def test_files_per_bucket_are_bounded(spark, buckets):
    names = spark.table(buckets[0]).inputFiles()
    folders = spark.table(buckets[0]).select("year", "month").distinct().count()
    assert folders < len(names) <= 4 * folders
    assert len({(n.rsplit("/", 1)[0], n.rsplit("_", 1)[1]) for n in names}) == len(names)  # one file per bucket


def test_partition_columns_are_listed_by_name(spark, buckets):
    listed = W.list_partitions(spark, buckets[0])
    assert listed.columns == ["year", "month"]
    assert listed.count() == spark.table(buckets[0]).select("year", "month").distinct().count()


def test_queries_share_one_warehouse(spark, small):
    from ledgerline.plans import queries

    assert queries.stored(spark, small) == queries.stored(spark, small)
    table = queries.registered(spark, small)
    assert queries.registered(spark, small) == table and spark.catalog.tableExists(table)


def test_models_are_fitted_once_per_table(clients, monkeypatch):
    from ledgerline.plans import queries

    fits = []
    monkeypatch.setattr(queries.M, "fit", lambda candidate, train: fits.append(candidate.name) or object())
    train, _ = queries.split_model_table(clients)
    again, _ = queries.split_model_table(clients.select("*"))
    assert queries._source(train) == queries._source(again)
    assert queries.fitted("GBT", train) is queries.fitted("GBT", again) and fits == ["GBT"]
    queries._made.clear()
