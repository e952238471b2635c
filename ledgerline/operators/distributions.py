"""Data behind distribution charts, computed as aggregates of the whole table.

One-row statistics enter later expressions as scalar subqueries, so no data
is collected and nothing is cross-joined.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerline.functions import columns as C
from ledgerline.operators import ordered
from ledgerline.session import fresh_dir
from ledgerline.sources.files import store

REACH = 9.0  # bandwidths


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-NULL level, most frequent first."""
    counts = ordered.value_counts(df, column).withColumnRenamed("n", "count")
    return counts.orderBy(F.desc("count"), column)


def shares(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    """Levels as a percentage of all non-NULL rows."""
    counts = ordered.value_counts(df, column)
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.select(
        column, F.col("n").alias("count"),
        F.round(100.0 * F.col("n") / total, digits).alias("share_pct"),
    )


def histogram(
    df: DataFrame, value: str, bins: int, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Equal-width bins from the smallest to the largest value, last bin closed.

    With ``low``/``high`` values are clipped to that range first. Empty bins
    are kept. The table is read twice, one column each time.
    """
    x = F.col(value).cast("double")
    if low is not None and high is not None:
        x = C.clip(x, float(low), float(high))
    points = df.select(x.alias("x")).where(F.col("x").isNotNull())
    span = points.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    # A single distinct value gets a bin range of width one around it.
    flat = F.col("lo") == F.col("hi")
    span = span.select(F.struct(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        (F.when(flat, F.lit(1.0)).otherwise(F.col("hi") - F.col("lo")) / bins).alias("width"),
    ).alias("span"))

    def with_span(frame):
        return frame.withColumn("span", span.scalar())

    place = F.floor((F.col("x") - F.col("span.lo")) / F.col("span.width"))
    counts = (
        with_span(points)
        .groupBy(F.least(place, F.lit(bins - 1)).cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = with_span(df.sparkSession.range(bins).withColumnRenamed("id", "bin"))
    # Both sides have at most `bins` rows.
    return frame.join(F.broadcast(counts), "bin", "left").select(
        F.col("bin").cast("int").alias("bin"),
        (F.col("span.lo") + F.col("bin") * F.col("span.width")).alias("left_edge"),
        (F.col("span.lo") + (F.col("bin") + 1) * F.col("span.width")).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("count"),
    )


def median(df: DataFrame, value: str) -> DataFrame:
    return ordered.quantiles(df, value, {"median": 0.5}, interpolate=True)


def density(df: DataFrame, value: str, points: int, by: str | None = None, levels: Sequence = ()) -> DataFrame:
    """Gaussian kernel density on an even grid from the smallest to the largest value.

    The bandwidth follows Scott's rule per group. Values are counted first, and
    each distinct value meets only the grid points within ``REACH`` bandwidths,
    fewer the more rows there are; a kernel beyond adds less than 3e-18 of its
    height. Without spread the density is NULL. ``levels`` lists the values of
    ``by``, which bounds the broadcast sides to one row per level (and point).
    """
    keys = [by] if by else []
    data = df.select(*keys, F.col(value).cast("double").alias("value")).where(
        F.col("value").isNotNull()
    )
    if by:
        data = data.where(F.col(by).isin(*levels))
    stats = data.groupBy(*keys).agg(F.struct(
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        (F.stddev_samp("value") * F.pow(F.count(F.lit(1)).cast("double"), F.lit(-0.2))).alias("h"),
    ).alias("s")).where("s.n > 0")
    # One row, or one per level; Spark computes it once for both its uses.
    grid = stats.select(*keys, "s", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    counts = ordered.value_counts(data, "value", keys)
    if by:
        counts = counts.join(F.broadcast(stats), by)
    else:
        counts = counts.withColumn("s", stats.scalar())
    reach, step = REACH * F.col("s.h"), (F.col("s.hi") - F.col("s.lo")) / (points - 1)
    first = F.ceil((F.col("value") - reach - F.col("s.lo")) / F.nullif(step, F.lit(0.0)))
    last = F.floor((F.col("value") + reach - F.col("s.lo")) / F.nullif(step, F.lit(0.0)))
    first, last = F.greatest(first, F.lit(0)).cast("int"), F.least(last, F.lit(points - 1)).cast("int")
    near = counts.withColumns({"first": first, "last": last}).where("first <= last").select(
        *keys, "value", "s", "n", F.explode(F.sequence("first", "last")).alias("point"))
    x = F.col("s.lo") + F.col("point") * step
    z = (x - F.col("value")) / F.nullif(F.col("s.h"), F.lit(0.0))
    weight = F.col("n") / F.nullif(F.col("s.n") * F.col("s.h") * math.sqrt(2 * math.pi), F.lit(0.0))
    sums = near.groupBy(*keys, "point").agg(F.sum(weight * F.exp(-0.5 * z * z)).alias("density"))
    # Both sides have at most one row per level and point.
    spread = F.col("s.h") > 0
    return grid.join(F.broadcast(sums), [*keys, "point"], "left").select(
        *keys, "point", x.alias("x"), F.when(spread, F.coalesce("density", F.lit(0.0))).alias("density"))


def box_stats(df: DataFrame, value: str, by: str, levels: Sequence) -> DataFrame:
    """Quartiles, whiskers at the last values within 1.5 IQR, and outliers per class.

    ``levels`` lists the classes, which bounds the broadcast quartile table.
    """
    counts = ordered.value_counts(df.where(F.col(by).isin(*levels)), value, [by])
    counts = store(counts, fresh_dir(df.sparkSession, "box"))
    quartiles = ordered.quantiles_of_counts(
        counts, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=[by], interpolate=True
    )
    counts = counts.join(F.broadcast(quartiles), by)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    return counts.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).cast("double").alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).cast("double").alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("n_outliers"),
    )


def correlation(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson matrix in long form ``(a, b, r)``.

    Each pair uses the rows where both values are present, and a constant
    column gives NULL. Sums of centred products are taken per combination of
    missing columns (mostly a single one), so all pairs share two scans.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    means = numbers.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("m"))
    centred = numbers.withColumn("_m", means.scalar()).select(
        *[(F.col(c) - F.col(f"_m.{c}")).alias(c) for c in columns]
    )
    missing = sum(F.col(c).isNull().cast("bigint") * 2**i for i, c in enumerate(columns))
    # Wide expressions are written as SQL text: one call each, not thousands.
    k = range(len(columns))
    products = [
        f"sum(`{columns[i]}` * `{columns[j]}`) AS s{i}_{j}"
        for i, j in itertools.combinations_with_replacement(k, 2)
    ]
    sums = centred.groupBy(missing.alias("_missing")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(f"s{i}") for i, c in enumerate(columns)],
        *[F.expr(p) for p in products],
    )
    cells = ", ".join(
        f"struct({i} AS i, {j} AS j, n, s{i} AS sa, s{j} AS sb, s{i}_{i} AS saa,"
        f" s{j}_{j} AS sbb, s{min(i, j)}_{max(i, j)} AS sab)"
        for i in k for j in k
    )
    names = F.array(*[F.lit(c) for c in columns])
    cells = sums.selectExpr(f"inline(array({cells}))")
    both = F.col("sa").isNotNull() & F.col("sb").isNotNull()
    total = cells.groupBy("i", "j").agg(*[
        F.sum(F.when(both, F.col(name))).alias(name)
        for name in ("n", "sa", "sb", "saa", "sbb", "sab")
    ])
    n, sa, sb = F.col("n"), F.col("sa"), F.col("sb")
    spread = (F.col("saa") - sa * sa / n) * (F.col("sbb") - sb * sb / n)
    r = (F.col("sab") - sa * sb / n) / F.sqrt(F.when(spread > 0, spread))
    return total.select(
        names[F.col("i")].alias("a"), names[F.col("j")].alias("b"), F.round(r, digits).alias("r")
    )


def crosstab(
    df: DataFrame, row: str, column: str, levels: Sequence, unknown: str | None = None
) -> DataFrame:
    """Contingency table with one count column ``<column>_<level>`` per level."""
    label = F.col(row) if unknown is None else F.coalesce(F.col(row), F.lit(unknown))
    table = df.groupBy(label.alias(row)).agg(*[
        F.count_if(F.col(column) == F.lit(level)).alias(f"{column}_{level}") for level in levels
    ])
    return table.where(F.col(row).isNotNull())
