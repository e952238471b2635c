"""Physical layout: partitioning, caching and plan inspection."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Iterator, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F


def times(df: DataFrame, copies: int) -> DataFrame:
    """Bag union of a table with itself."""
    result = df
    for _ in range(copies - 1):
        result = result.unionByName(df)
    return result


def repartition_by(
    df: DataFrame, partitions: int, key: str, salt_on: Sequence[str] = (), salts: int | None = None
) -> DataFrame:
    """Hash-partition by key, optionally splitting each key over several partitions.

    Without ``salt_on`` one key is one partition and a following aggregate by
    that key needs no further exchange. That fits evenly sized keys only: with
    few or hot keys pass ``salt_on`` (ideally the row key); each key then
    covers up to ``salts`` partitions, all of them by default, and the
    aggregate combines within a partition and shuffles one row per key.
    """
    if not salt_on:
        return df.repartition(partitions, key)
    return df.repartition(partitions, F.col(key), F.pmod(F.xxhash64(*salt_on), F.lit(salts or partitions)))


def spread(df: DataFrame, rows_per_task: int = 15_000, most_per_task: int = 500_000) -> DataFrame:
    """Rows dealt evenly over as many tasks as their number is worth, for jobs that pass over them often.

    A stored table is read in as few tasks as its files have row groups. Here
    tasks take ``rows_per_task`` rows until there are two for every core, then
    more, up to ``most_per_task``, which bounds what one task holds. A table
    for one task stays as it is. Rows are sorted within a task, so a task holds
    them in the same order whenever it is repeated.
    """
    rows = df.count()
    wide = min(-(-rows // rows_per_task), 2 * df.sparkSession.sparkContext.defaultParallelism)
    tasks = max(wide, -(-rows // most_per_task))
    return df.repartition(tasks).sortWithinPartitions(*df.columns) if tasks > 1 else df


@contextlib.contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a table (select the needed columns first) for reuse, then release it."""
    held = df.persist(level)
    try:
        yield held
    finally:
        held.unpersist()


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan that ``explain`` prints."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def run_only(df: DataFrame) -> None:
    """Execute every column of a plan and throw the rows away."""
    df.write.format("noop").mode("overwrite").save()


def preview(df: DataFrame, rows: int, *order: str) -> list:
    """The first rows in a stated order, for display."""
    return (df.orderBy(*order) if order else df).limit(rows).collect()
