"""Helpers the operators share: shipping the package, stored tables, empty texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.session import fresh_dir, ship
from ledgerline.sources import files

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the folder all executors share and go on from its files.

    Shuffle files of the write are not needed any more and go at once.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    path = fresh_dir(df.sparkSession, purpose)
    try:
        table = files.store(df, path)
    finally:
        conf.set(_CLEANUP, before)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def whole_text(column: str = "text") -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")
