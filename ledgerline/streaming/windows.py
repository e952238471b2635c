"""Transaction tagging and windowed totals, the same code for batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerline import schemas
from ledgerline.functions import columns as C


def tag(df: DataFrame, threshold: float = schemas.SUSPICIOUS_ABOVE) -> DataFrame:
    """Mark transactions above the threshold; a NULL amount stays unmarked."""
    return df.withColumn("suspicious", C.above("amount", threshold))


def windowed(
    tagged: DataFrame, seconds: int = schemas.WINDOW_SECONDS, by: Sequence[str] = ("job",),
    lateness: str = schemas.LATENESS,
) -> DataFrame:
    """Count, total and marked transactions per tumbling window and group.

    The watermark bounds state in append and update mode. Complete mode keeps
    every window and accepts late rows; a batch table ignores the watermark.
    """
    return (
        tagged.withWatermark("txn_time", lateness)
        .groupBy(F.window("txn_time", f"{seconds} seconds"), *by)
        .agg(
            F.count(F.lit(1)).alias("n_txn"),
            F.round(F.sum("amount"), 2).alias("total_amount"),
            F.sum("suspicious").alias("n_suspicious"),
        )
    )


def sliding(
    tagged: DataFrame, seconds: int = schemas.WINDOW_SECONDS, slide: int = 10, by: Sequence[str] = ("job",),
    lateness: str = schemas.LATENESS,
) -> DataFrame:
    """The same totals per overlapping window of ``seconds``, one starting every ``slide`` seconds.

    Rows are first summed per pane of one slide; the few panes, not the rows,
    are then repeated for the windows they lie in. ``seconds`` must be a
    multiple of ``slide``. On a stream (append mode) both steps keep state:
    a pane closes by the watermark and then enters its windows.
    """
    if seconds % slide:
        raise ValueError("the window must be a multiple of the slide")
    panes = (
        tagged.withWatermark("txn_time", lateness)
        .groupBy(F.window("txn_time", f"{slide} seconds").alias("pane"), *by)
        .agg(
            F.count(F.lit(1)).alias("n_txn"), F.sum("amount").alias("total_amount"),
            F.sum("suspicious").alias("n_suspicious"),
        )
    )
    return (
        panes.groupBy(F.window(F.window_time("pane"), f"{seconds} seconds", f"{slide} seconds"), *by)
        .agg(
            F.sum("n_txn").alias("n_txn"), F.round(F.sum("total_amount"), 2).alias("total_amount"),
            F.sum("n_suspicious").alias("n_suspicious"),
        )
    )


def flatten(windows: DataFrame) -> DataFrame:
    """Window start and end as plain columns."""
    return windows.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *[c for c in windows.columns if c != "window"],
    )


def latest_first(windows: DataFrame) -> DataFrame:
    """Newest window first, biggest total first (complete mode or batch only)."""
    return windows.orderBy(F.desc("window"), F.desc("total_amount"))


def rollup(windows: DataFrame, by: str = "job") -> DataFrame:
    """Window totals summed per group, biggest total first."""
    return (
        windows.groupBy(by)
        .agg(
            F.round(F.sum("total_amount"), 2).alias("total_amount"),
            F.sum("n_txn").alias("n_txn"),
            F.sum("n_suspicious").alias("n_suspicious"),
        )
        .orderBy(F.desc("total_amount"))
    )
