import datetime

import pytest
from tests.helpers import values
from pyspark.sql import functions as F

from ledgerline import schemas, session
from ledgerline.operators import cleaning
from ledgerline.plans import campaign_job, queries, reports
from ledgerline.sources import files, standin, warehouse as W


def test_csv_schema_declared_and_inferred(spark, small):
    path = session.fresh_dir(spark, "csv")
    table = queries.raw_only(spark, small)
    files.write_csv(table, path)
    declared = files.read_campaign_csv(spark, path)
    inferred = files.read_campaign_csv(spark, path, schema=None)
    assert declared.schema == schemas.RAW_CAMPAIGN == inferred.schema
    assert values(declared) == values(inferred) == values(table)


def test_csv_other_separator(spark, tmp_path):
    path = tmp_path / "bank.csv"
    path.write_text("age;job\n30;\"admin.\"\n")
    schema = schemas.RAW_CAMPAIGN[:2]
    from pyspark.sql.types import StructType
    rows = files.read_campaign_csv(spark, str(path), StructType(schema.fields), sep=";").collect()
    assert [tuple(r) for r in rows] == [(30, "admin.")]


def test_transactions_permissive(spark, tmp_path):
    (tmp_path / "batch.json").write_text(
        '{"txn_id":"1","account_id":"A","job":"x","amount":1.5,"currency":"EUR",'
        '"txn_time":"2026-05-11T23:56:07.123456"}\n'
        '{"txn_id":"2","amount":"many"}\n'
        '{"txn_id":"3", broken\n'
        '{"txn_id":"4","txn_time":null}\n')
    df = files.read_transactions(spark, str(tmp_path))
    assert df.schema == schemas.TRANSACTION
    rows = df.collect()
    assert len(rows) == 4
    good = next(r for r in rows if r["txn_id"] == "1")
    assert good["amount"] == 1.5
    assert good["txn_time"] == datetime.datetime(2026, 5, 11, 23, 56, 7, 123456)
    assert sum(r["amount"] is None for r in rows) == 3


def test_table_partitions_appear_after_recovery(spark, clients):
    path = session.fresh_dir(spark, "table")
    W.write_warehouse(clients.drop("row_id"), path)
    W.register_table(spark, "recovered", path, recover=False)
    assert spark.table("recovered").count() == 0
    W.recover_partitions(spark, "recovered")
    assert spark.table("recovered").count() == clients.count()
    assert values(W.list_partitions(spark, "recovered")) == values(clients.select("month").distinct())
    assert spark.table("recovered").schema == schemas.CLEAN_CAMPAIGN
    assert spark.table("recovered").select("`default`").count() > 0
    W.drop_table(spark, "recovered")
    assert spark.read.parquet(path).count() == clients.count()


def test_campaign_job(spark, small):
    base = session.fresh_dir(spark, "job")
    table = queries.raw_only(spark, small)
    files.write_csv(table, f"{base}/csv")
    campaign_job.run(
        spark, f"{base}/csv", f"{base}/warehouse", f"{base}/reports",
        database="job_test", database_location=f"{base}/db")
    stored = spark.table("job_test.bank_clients")
    assert values(stored, *sorted(stored.columns)) == values(
        cleaning.clean(table), *sorted(stored.columns))
    names = [r["tableName"] for r in W.list_tables(spark, "job_test").collect()]
    assert names == ["bank_clients"]
    exported = spark.read.option("header", True).option("inferSchema", True).csv(f"{base}/reports/job")
    assert values(exported, "job", "n_clients", "n_subscribed", reports.RATE) == values(
        reports.REPORTS["job"].run(stored), "job", "n_clients", "n_subscribed", reports.RATE)
    assert set(reports.run_all(stored)) == {*reports.REPORTS, "duration_cohort", "poutcome_rank"}
    # A second run replaces the first.
    W.write_warehouse(cleaning.clean(table), f"{base}/warehouse")
    assert spark.read.parquet(f"{base}/warehouse").count() == table.count()
    spark.sql("DROP TABLE job_test.bank_clients")
    spark.sql("DROP DATABASE job_test")


def test_write_without_rebalancing(spark, clients):
    path = session.fresh_dir(spark, "plain")
    W.write_warehouse(clients, path, even_out=False)
    assert spark.read.parquet(path).count() == clients.count()


def test_literal_table_has_known_size(spark):
    table = files.literal_table(spark, standin.STANDIN_SECTORS, ["job", "sector"])
    assert table.count() == 4
    assert "LocalTableScan" in table._jdf.queryExecution().executedPlan().toString()


def test_shared_dir_follows_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.fresh_dir(spark, "a") != session.fresh_dir(spark, "a")
    session.ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir().startswith(
        "file:" + spark.conf.get("spark.checkpoint.dir"))


def test_session_settings(spark):
    assert session.build_session("again").sparkContext is spark.sparkContext
    own = spark.conf.get("spark.sql.shuffle.partitions")
    assert session.stream_session(spark).conf.get("spark.sql.shuffle.partitions") == own
    assert session.stream_session(spark, 7).conf.get("spark.sql.shuffle.partitions") == "7"
    assert spark.conf.get("spark.sql.shuffle.partitions") == own
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_remote_master_without_shared_dir_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_rounding_is_half_up_on_decimal_text(spark):
    row = spark.range(1).select(*[F.round(F.lit(v), d) for v, d in
                                  ((0.285, 2), (1.005, 2), (2.5, 0), (-2.5, 0))]).first()
    assert tuple(row) == (0.29, 1.01, 3.0, -3.0)
