"""Reading and writing CSV, JSON lines and Parquet."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerline import schemas


def read_campaign_csv(
    spark: SparkSession, path: str, schema: StructType | None = schemas.RAW_CAMPAIGN, sep: str = ","
) -> DataFrame:
    """Campaign CSV with a header.

    The declared schema saves a pass over the file and must agree with the
    header, or reading fails; ``schema=None`` infers it.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema).option(
        "enforceSchema", False)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines transactions; a bad field becomes NULL and its row stays."""
    return spark.read.schema(schemas.TRANSACTION).option("mode", "PERMISSIVE").json(path)


def stream_transactions(
    spark: SparkSession, path: str, files_per_trigger: int | None = 1
) -> DataFrame:
    """The same JSON lines as an unbounded table over a watched folder."""
    reader = spark.readStream.schema(schemas.TRANSACTION)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def write_transactions(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    ).json(path)


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a table once and go on from the files: cuts lineage, survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_report(report: DataFrame, path: str) -> None:
    """One CSV file for one aggregated report (a few rows per group)."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def literal_table(spark: SparkSession, rows, columns) -> DataFrame:
    """Small table from Python tuples.

    Handed over as Arrow it becomes a local relation, whose size the optimizer
    knows when it picks a join strategy.
    """
    values = [pa.array(list(column)) for column in zip(*rows, strict=True)]
    return spark.createDataFrame(pa.table(values, names=list(columns)))
