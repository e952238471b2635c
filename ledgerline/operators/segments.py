"""Grouped reports over segments of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.functions import columns as C
from ledgerline.sources.files import literal_table


def segment(
    df: DataFrame, by: Sequence[str], measures: Sequence[Column],
    unknown: str | None = None, rename: dict[str, str] | None = None,
) -> DataFrame:
    """Aggregate ``measures`` per group and label NULL groups.

    Labelling comes after grouping: NULL and a literal 'unknown' stay two rows.
    """
    result = df.groupBy(*by).agg(*measures)
    if unknown is not None:
        result = result.withColumns({k: F.coalesce(F.col(k), F.lit(unknown)) for k in by})
    return result.withColumnsRenamed(rename or {})


def ranked(df: DataFrame, by: str, target: str, unknown: str, measures: Sequence[Column]) -> DataFrame:
    """Segment report with the rank of each group's unrounded mean, ties sharing a rank.

    The window runs over one row per group, after the aggregate.
    """
    result = segment(df, [by], [*measures, F.avg(target).alias("_mean")], unknown)
    place = F.rank().over(Window.orderBy(F.desc("_mean")))
    return result.withColumn("rate_rank", place).drop("_mean")


def best_first(report: DataFrame, metric: str, *ties: str) -> DataFrame:
    """Highest metric first, then by group key so that ties have one order."""
    return report.orderBy(F.desc(metric), *ties)


def on_calendar(
    report: DataFrame, key: str, ordered_values: Sequence[str], position: str
) -> DataFrame:
    """Report re-indexed to a full ordered list of keys; absent keys get NULLs."""
    spark = report.sparkSession
    frame = literal_table(spark, enumerate(ordered_values, 1), [position, key])
    frame = frame.withColumn(position, F.col(position).cast("int"))
    return frame.join(report, key, "left").orderBy(position)


def rate_by(df: DataFrame, by: str, target: str, unknown: str | None = None) -> DataFrame:
    """Mean of the target per level, NULL merged with the ``unknown`` label first."""
    level = F.col(by) if unknown is None else F.coalesce(F.col(by), F.lit(unknown))
    return df.groupBy(level.alias(by)).agg((100.0 * F.avg(target)).alias("rate_pct"))


def mean_by(df: DataFrame, by: str, value: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg(value).alias(f"avg_{value}"))


def measure_count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def measure_sum(column: str, name: str) -> Column:
    return F.sum(column).alias(name)


def measure_avg(column: str, name: str, digits: int) -> Column:
    return F.round(F.avg(column), digits).alias(name)


def measure_rate(target: str = "y", name: str = "subscription_rate_pct") -> Column:
    return C.percent(target).alias(name)
