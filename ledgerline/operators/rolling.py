"""Scores against a rolling history of the same account, exact and linear in the rows.

A sliding RANGE frame is summed anew for every row. Here each row enters the
history at its time and leaves it one span later, as a second, negative row; a
running sum over both is the history of any moment. Accounts are cut into time
slices, and each slice starts from the summed slices before it, so one busy
account is the work of many tasks and no row is read twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

MICROS_PER_DAY = 86_400_000_000
SCALE = 2
_MOMENTS = ("_n", "_s", "_q")


def _whole(value: Column, scale: int) -> Column:
    """The value in its smallest unit as an exact whole number; NULL if it is not finite or has over 18 digits."""
    return F.round(value.cast("double") * 10**scale).try_cast("decimal(18,0)")


def _history(events: DataFrame, by: Sequence[str], slice_micros: int) -> DataFrame:
    """Add the moments of all events of the same group strictly before each event's time."""
    sliced = events.withColumn("_slice", F.floor(F.col("_t") / slice_micros))
    totals = sliced.groupBy(*by, "_slice").agg(*[F.sum(m).alias(m) for m in _MOMENTS])
    # One row per group and slice of time in use.
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *by, "_slice", *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"{m}_carried") for m in _MOMENTS])
    same = [sliced[c].eqNullSafe(carried[c]) for c in (*by, "_slice")]
    inside = Window.partitionBy(*by, "_slice").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    joined = sliced.join(carried, same).select(
        sliced["*"], *[carried[f"{m}_carried"] for m in _MOMENTS])
    return joined.select(
        *events.columns,
        *[(F.col(f"{m}_carried") + F.coalesce(F.sum(m).over(inside), F.lit(0))).alias(f"{m}_before") for m in _MOMENTS])


def _spread() -> Column:
    """``n * q - s * s`` of the history: exact as long as it has 38 digits, in doubles beyond."""
    exact = F.expr("try_subtract(try_multiply(_n_, _q_), try_multiply(_s_, _s_))")
    rough = F.col("_n_").cast("double") * F.col("_q_") - F.col("_s_").cast("double") * F.col("_s_")
    return F.coalesce(exact.cast("double"), rough)


def rolling_zscore(
    df: DataFrame, value: str, at: str, by: Sequence[str], days: int = 30, scale: int = SCALE, slice_days: float = 1.0,
) -> DataFrame:
    """Add ``n_before``, ``mean_before`` and ``zscore`` of each row against its group's last ``days`` days.

    The history of a row at time t is the rows of the same ``by`` values with a
    value and a time in [t - days, t): rows of the same time do not see each
    other. ``zscore`` is the distance from the history's mean in sample
    standard deviations, NULL where the history has fewer than two values or no
    variance, or the row has no value. Values count to ``scale`` decimals, so sums are exact and a
    history of equal values has no variance at all. Rows without a time have
    no history and are in none (``n_before`` 0). NULL in ``by`` is a group
    of its own. Repeated rows count as often as they occur; an empty table stays
    empty. ``slice_days`` is the stretch of an account's time that one task sums up.
    """
    span, slice_micros = days * MICROS_PER_DAY, int(slice_days * MICROS_PER_DAY)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    groups = [f"_by{i}" for i in range(len(by))]
    cents = _whole(F.col(f"`{value}`"), scale)
    keyed = df.select(
        row.alias("_row"), *[F.col(f"`{c}`").alias(g) for c, g in zip(by, groups)],
        F.unix_micros(F.col(f"`{at}`").cast("timestamp")).alias("_t"), cents.alias("_v"))

    def events(sign: int) -> list[Column]:
        counted = F.when(F.col("_v").isNotNull(), sign).otherwise(0)
        return [
            counted.cast("decimal(38,0)").alias("_n"), (counted * F.coalesce("_v", F.lit(0))).cast("decimal(38,0)").alias("_s"),
            (counted * F.coalesce(F.col("_v") * F.col("_v"), F.lit(0))).cast("decimal(38,0)").alias("_q")]

    timed = keyed.where("_t is not null")
    enters = timed.select("_row", *groups, "_t", *events(1))
    # A value is history up to and including the moment `span` after its time.
    leaves = timed.where("_v is not null").select(
        F.lit(None).cast(df.select(row.alias("r")).schema["r"].dataType).alias("_row"), *groups, (F.col("_t") + span).alias("_t"), *events(-1))
    scored = _history(enters.unionByName(leaves), groups, slice_micros).where("_row is not null").select(
        "_row", *[F.col(f"{m}_before").cast("decimal(38,0)").alias(f"{m}_") for m in _MOMENTS])
    untimed = keyed.where("_t is null").select("_row", *[F.lit(0).cast("decimal(38,0)").alias(f"{m}_") for m in _MOMENTS])
    n, s = F.col("_n_").cast("double"), F.col("_s_").cast("double")
    own = _whole(F.col("_row")[value], scale).cast("double")
    variance = F.col("_spread") / F.nullif(n * (n - 1), F.lit(0.0))
    return scored.unionByName(untimed).withColumn("_spread", _spread()).select(
        "_row.*", F.col("_n_").cast("bigint").alias("n_before"),
        (s / F.nullif(n, F.lit(0.0)) / 10**scale).alias("mean_before"),
        F.when(F.col("_spread") > 0, (own - s / n) / F.sqrt(variance)).alias("zscore"))


def tag_unusual(scored: DataFrame, beyond: float = 3.0) -> DataFrame:
    """Mark rows more than ``beyond`` deviations away from their history; no score, no mark."""
    return scored.withColumn("unusual", F.coalesce((F.abs("zscore") > beyond).cast("int"), F.lit(0)))
