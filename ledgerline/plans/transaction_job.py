"""Streaming job: watched folder to windowed totals per job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ledgerline import schemas
from ledgerline.sources.files import stream_transactions
from ledgerline.streaming import runner, windows


def window_stream(
    spark: SparkSession, input_path: str, seconds: int = schemas.WINDOW_SECONDS,
    threshold: float = schemas.SUSPICIOUS_ABOVE, files_per_trigger: int | None = 1,
) -> DataFrame:
    stream = stream_transactions(spark, input_path, files_per_trigger)
    return windows.windowed(windows.tag(stream, threshold), seconds)


def watch(
    spark: SparkSession, input_path: str, checkpoint: str, run_seconds: int | None = 60,
    seconds: int = schemas.WINDOW_SECONDS, threshold: float = schemas.SUSPICIOUS_ABOVE,
    attach: Callable[[DataFrame, str], DataStreamWriter] = runner.to_console,
) -> StreamingQuery:
    """Show all windows, newest first, for a while or (``run_seconds=None``) until stopped."""
    result = windows.latest_first(window_stream(spark, input_path, seconds, threshold))
    return runner.run_for(attach(result, checkpoint), run_seconds)


def archive(
    spark: SparkSession, input_path: str, output_path: str, checkpoint: str,
    seconds: int = schemas.WINDOW_SECONDS, threshold: float = schemas.SUSPICIOUS_ABOVE,
    files_per_trigger: int | None = None, timeout: int | None = None,
) -> StreamingQuery:
    """Append closed windows of everything that has arrived to Parquet, then stop."""
    result = window_stream(spark, input_path, seconds, threshold, files_per_trigger)
    return runner.run_available(
        runner.to_files(windows.flatten(result), output_path, checkpoint), timeout
    )
