"""Exact order statistics without a global sort in one task.

Spark's exact ``percentile`` keeps every distinct value of a group in one
task. Here values are first counted (copies combine before the shuffle), then
spread over cells of neighbouring values. Each cell is ordered on its own and
starts from the total of the cells before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.session import fresh_dir
from ledgerline.sources.files import store

ROWS_PER_CELL = 100_000
_INDEX_BITS = 33  # of a monotonically increasing id: the row's index in its partition


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One row ``(by..., value, n)`` per distinct value; NULL and NaN are left out."""
    present = df.where(F.col(value).isNotNull())
    if dict(df.dtypes)[value] in ("float", "double"):
        present = present.where(~F.isnan(value))
    return present.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def _cell_edges(counts: DataFrame, value: str, cells: int) -> list[float]:
    """Approximate cut points, a bounded list from a part of the values.

    They only balance the work: any cut points give the same results.
    """
    shares = [i / cells for i in range(1, cells)]
    cuts = counts.sample(0.1, seed=1).approxQuantile(value, shares, 1 / (4 * cells)) if shares else []
    return [float("-inf"), *sorted(set(cuts) or {0.0}), float("inf")]


def running_counts(
    counts: DataFrame, value: str, measures: Sequence[str] = ("n",),
    by: Sequence[str] = (), rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Add ``<m>_through`` and ``<m>_total`` to one-row-per-value counts.

    ``through`` sums a measure over all values up to and including the row's
    value within its ``by`` group; ``total`` sums it over the group. ``by``
    columns must not be NULL. The counts are stored, so the table behind them
    is read once. One task orders one cell, of which there are as many as
    the counts have ``rows_per_cell``.
    """
    spark = counts.sparkSession
    counts = store(counts.withColumn("_at", F.col(value).cast("double")), fresh_dir(spark, "value-counts"))
    edges = _cell_edges(counts, "_at", -(-counts.count() // rows_per_cell))
    placed = Bucketizer(splits=edges, inputCol="_at", outputCol="_cell").transform(counts)

    # At most `cells` rows per group, so these windows stay small.
    per_cell = placed.groupBy(*by, "_cell").agg(*[F.sum(m).alias(m) for m in measures])
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_cell.select(
        *by, "_cell",
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"{m}_offset") for m in measures],
        *[F.sum(m).over(group).alias(f"{m}_total") for m in measures],
    )
    inside = Window.partitionBy(*by, "_cell").orderBy("_at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        placed.join(offsets, [*by, "_cell"])
        .withColumns({
            f"{m}_through": F.col(f"{m}_offset") + F.sum(m).over(inside) for m in measures
        })
        .drop("_at", "_cell", *[f"{m}_offset" for m in measures])
    )


def _discrete(value: str, share: float) -> Column:
    """Smallest value whose cumulative share reaches ``share``."""
    return F.min(F.when(F.col("n_through") >= F.lit(share) * F.col("n_total"), F.col(value)))


def _interpolated(value: str, share: float) -> Column:
    """Linear interpolation between the two values around ``share * (n - 1)``."""
    place = F.lit(share) * (F.col("n_total") - 1)
    lower = F.min(F.when(F.col("n_through") > F.floor(place), F.col(value)))
    upper = F.min(F.when(F.col("n_through") > F.ceil(place), F.col(value)))
    weight = F.max(place - F.floor(place))
    return lower + weight * (upper - lower)


def quantiles(
    df: DataFrame, value: str, shares: dict[str, float], by: Sequence[str] = (),
    interpolate: bool = False,
) -> DataFrame:
    """Exact quantiles, one column per entry of ``shares``."""
    return quantiles_of_counts(value_counts(df, value, by), value, shares, by, interpolate)


def quantiles_of_counts(
    counts: DataFrame, value: str, shares: dict[str, float], by: Sequence[str] = (), interpolate: bool = False,
) -> DataFrame:
    """The same from one row ``(by..., value, n)`` per distinct value."""
    running = running_counts(counts, value, by=by)
    pick = _interpolated if interpolate else _discrete
    return running.groupBy(*by).agg(
        *[pick(value, share).cast("double").alias(name) for name, share in shares.items()]
    )


def row_numbers(df: DataFrame, order: Sequence[Column], name: str = "place") -> DataFrame:
    """Add the place of each row in the whole table's order, from 1, with no task that holds it all.

    Rows are partitioned by range and sorted within; each place is the index in
    the partition plus the rows of the partitions before, of which there are
    ``spark.sql.shuffle.partitions``. Rows that the order leaves equal, however
    many, are told apart by their place in the input, which should be a stored
    table: it is read once for the ranges and once for the rows. An empty
    table stays empty.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*order, F.col("_tie")]
    # Sorted in the partitions first, numbered next: the id holds partition and index.
    numbered = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(
        parts, *order).sortWithinPartitions(*order).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    rows = store(numbered, fresh_dir(spark, "row-numbers")).withColumn(
        "_part", F.shiftright("_at", _INDEX_BITS))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    index = F.col("_at").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    return rows.join(F.broadcast(before), "_part").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + index + 1).alias(name))
