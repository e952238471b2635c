"""Batch job: CSV to a partitioned warehouse, a catalog table and exported reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import cleaning
from ledgerline.plans import reports
from ledgerline.sources import files, warehouse


def build_warehouse(
    spark: SparkSession, csv_path: str, warehouse_path: str,
    database: str = "bank_warehouse", table: str = "bank_clients",
    database_location: str | None = None, sep: str = ",",
) -> DataFrame:
    """Load, clean, store by month, register; returns the registered table."""
    raw = files.read_campaign_csv(spark, csv_path, sep=sep)
    warehouse.write_warehouse(cleaning.clean(raw), warehouse_path)
    warehouse.create_database(spark, database, database_location)
    warehouse.register_table(spark, f"{database}.{table}", warehouse_path)
    return spark.table(f"{database}.{table}")


def run(
    spark: SparkSession, csv_path: str, warehouse_path: str, reports_path: str, **options
) -> None:
    """Reports read the stored table, so nothing has to stay cached."""
    clients = build_warehouse(spark, csv_path, warehouse_path, **options)
    reports.export_all(clients, reports_path)
