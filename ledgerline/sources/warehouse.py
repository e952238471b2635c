"""Partitioned Parquet warehouse and its catalog entry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline import schemas


def write_warehouse(df: DataFrame, path: str, by: str = "month", even_out: bool = True) -> None:
    """Overwrite a folder with one subfolder per partition value.

    Without ``even_out`` every task writes a file into every partition folder.
    The rebalance hint gathers a partition value into files near the advisory
    size, and AQE splits a value that holds much of the table over many tasks.
    """
    if even_out:
        df = df.hint("rebalance", by)
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def write_bucketed(
    df: DataFrame, table: str, path: str, buckets: int, by: str, partitions: Sequence[str] = ("year", "month"),
) -> None:
    """Catalog table in folders per partition value, each with one file per bucket of ``by`` in use.

    Rows are dealt by the hash that names the buckets, so a task writes one
    bucket and a folder gets at most ``buckets`` files. Tables with the same
    buckets join on ``by`` without a shuffle, and a filter on one value of
    ``by`` reads one bucket. A value that holds much of the table fills one
    bucket, which one task reads: join such keys by ``shuffle_join``.
    """
    writer = df.repartition(buckets, by).write.mode("overwrite").option("path", path)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.bucketBy(buckets, by).sortBy(by).saveAsTable(table)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def register_table(
    spark: SparkSession, table: str, path: str,
    schema=schemas.CLEAN_CAMPAIGN, by: str = "month", recover: bool = True,
) -> None:
    """External table over a warehouse folder; dropping it keeps the files."""
    columns = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields
    )
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (`{by}`) LOCATION '{path}'"
    )
    if recover:
        recover_partitions(spark, table)


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Enter the partition folders found on disk into the catalog."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{database}`")


def list_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Partition values as text, one row per folder and one column per partition column."""
    by = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    values = F.split("partition", "/")
    return spark.sql(f"SHOW PARTITIONS {table}").select(
        *[F.substring_index(values[i], "=", -1).alias(c) for i, c in enumerate(by)])


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
