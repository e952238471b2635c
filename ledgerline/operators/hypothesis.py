"""Two-sample and independence tests from one aggregate each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerline.functions import tails
from ledgerline.operators import distributions

ALPHA = 0.05


def welch(df: DataFrame, value: str, label: str, first=1, second=0, alpha: float = ALPHA) -> DataFrame:
    """Welch's t-test of ``value`` between two label values, one scan; NULL without variance."""
    def side(level, tag):
        x = F.when(F.col(label) == F.lit(level), F.col(value))
        return [
            F.count(x).alias(f"n_{tag}"), F.avg(x).alias(f"mean_{tag}"),
            (F.var_samp(x) / F.nullif(F.count(x), F.lit(0))).alias(f"se2_{tag}"),
        ]

    row = df.agg(*side(first, "a"), *side(second, "b"))
    error = F.col("se2_a") + F.col("se2_b")
    spread = sum(
        F.pow(f"se2_{tag}", F.lit(2)) / F.nullif(F.col(f"n_{tag}") - 1, F.lit(0)) for tag in ("a", "b"))
    dof = error * error / F.nullif(spread, F.lit(0.0))
    row = row.select(
        "n_a", "n_b",
        ((F.col("mean_a") - F.col("mean_b")) / F.nullif(F.sqrt(error), F.lit(0.0))).alias("t"),
        dof.alias("dof"),
    )
    p = tails.student_t_two_sided(F.col("t"), F.col("dof"))
    return row.withColumn("p_value", p).withColumn("reject", F.col("p_value") < alpha)


def expected_counts(
    df: DataFrame, row: str, column: str, levels: Sequence, unknown: str | None = None
) -> DataFrame:
    """Observed and expected count per cell, cells without rows included."""
    names = [f"{column}_{level}" for level in levels]
    table = distributions.crosstab(df, row, column, levels, unknown)
    totals = table.agg(F.struct(*[F.sum(n).alias(n) for n in names]).alias("t")).scalar()
    table = table.withColumn("_totals", totals).withColumn("_row", sum(F.col(n) for n in names))
    grand = sum(F.col(f"_totals.{n}") for n in names)
    cells = F.array(*[
        F.struct(
            F.lit(level).alias(column), F.col(n).alias("observed"),
            (F.col("_row") * F.col(f"_totals.{n}") / F.nullif(grand, F.lit(0))).alias("expected"),
        )
        for level, n in zip(levels, names)
    ])
    return table.select(row, F.inline(cells))


def chi_squared(
    df: DataFrame, row: str, column: str, levels: Sequence, unknown: str | None = None,
    correction: bool = True, alpha: float = ALPHA,
) -> DataFrame:
    """Pearson's test of independence.

    With ``correction`` a table with one degree of freedom moves every
    observed count up to one half towards its expected count (Yates). Cells
    that nothing is expected in, as for a level without rows, add nothing.
    """
    cells = expected_counts(df, row, column, levels, unknown)
    gap = F.abs(F.col("observed") - F.col("expected"))
    expected = F.nullif(F.col("expected"), F.lit(0.0))
    plain = gap * gap / expected
    shifted = gap - F.least(gap, F.lit(0.5))
    corrected = shifted * shifted / expected
    result = cells.agg(
        F.sum(plain).alias("plain"), F.sum(corrected).alias("corrected"),
        ((F.count(F.lit(1)) / len(levels) - 1) * (len(levels) - 1)).cast("int").alias("dof"),
    )
    adjusted = (F.col("dof") == 1) & F.lit(correction)
    result = result.select(
        F.when(adjusted, F.col("corrected")).otherwise(F.col("plain")).alias("chi2"), "dof"
    )
    p = tails.chi_squared_tail(F.col("chi2"), F.col("dof"))
    return result.withColumn("p_value", p).withColumn("reject", F.col("p_value") < alpha)
