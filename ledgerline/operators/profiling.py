"""Table profiles. Each profile reads every column once, whatever the width."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from ledgerline.functions import columns as C
from ledgerline.operators import ordered


def _one_row_per_column(
    df: DataFrame, columns: Sequence[str], cells: dict[str, tuple[str, Callable[[str], str]]]
) -> DataFrame:
    """Turn aggregates of many columns into one row per column.

    ``cells`` maps an output name to its type and to the SQL of the aggregate
    for a (quoted) column. All aggregates run in one job; the single result
    row is then unfolded. SQL text keeps the plan quick to build when wide.
    """
    def row(c):
        values = [
            f"CAST({make(C.quoted(c))} AS {kind}) AS {C.quoted(name)}"
            for name, (kind, make) in cells.items()
        ]
        return f"struct({C.literal(c)} AS `column`, {', '.join(values)})"

    folded = df.agg(*[F.expr(row(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    return folded.selectExpr(f"inline(array({', '.join(folded.columns)}))")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def duplicates(df: DataFrame) -> DataFrame:
    """Total, distinct and surplus rows in one pass; NULLs compare equal.

    Copies combine on the map side, so one heavily copied row costs one row
    per map task in the shuffle.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).withColumn("duplicates", F.col("total_rows") - F.col("distinct_rows"))


def null_summary(df: DataFrame) -> DataFrame:
    return _one_row_per_column(
        df, df.columns, {"n_null": ("bigint", lambda c: f"count_if({c} IS NULL)")}
    )


def sentinel_rates(df: DataFrame, sentinels: dict[str, object]) -> DataFrame:
    """How often each column holds its 'missing' code, as count and percent."""
    codes = {C.quoted(c): C.literal(code) for c, code in sentinels.items()}

    def hits(c):
        return f"count_if({c} = {codes[c]})"

    return _one_row_per_column(df, list(sentinels), {
        "n_sentinel": ("bigint", hits),
        "pct": ("double", lambda c: f"round(100.0D * {hits(c)} / nullif(count(*), 0), 2)"),
    })


def describe(df: DataFrame, numeric: Sequence[str], digits: int = 6) -> DataFrame:
    """Count, mean, sample standard deviation, min and max per column.

    Numbers and texts are two aggregates over disjoint columns: text extremes
    would keep the numeric part out of the fast hash aggregate.
    """
    def profile(columns, mean, stddev):
        return _one_row_per_column(df, columns, {
            "count": ("bigint", lambda c: f"count({c})"),
            "mean": ("double", mean),
            "stddev": ("double", stddev),
            "min": ("string", lambda c: f"min({c})"),
            "max": ("string", lambda c: f"max({c})"),
        })

    numbers = [c for c in df.columns if c in numeric]
    texts = [c for c in df.columns if c not in numeric]
    parts = []
    if numbers:
        parts.append(profile(
            numbers,
            lambda c: f"round(avg({c}), {digits})", lambda c: f"round(stddev_samp({c}), {digits})",
        ))
    if texts:
        parts.append(profile(texts, lambda c: "NULL", lambda c: "NULL"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct (column, value) pairs of all columns in one shuffle."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], list(columns), "column", "value").groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def cardinality(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values per column; NULL counts as a value."""
    values = _distinct_values(df, columns or df.columns)
    return values.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def cardinality_approx(df: DataFrame, columns: Sequence[str] | None = None, rsd: float = 0.05) -> DataFrame:
    """Sketch-based distinct counts: one pass, no shuffle of values."""
    def distinct(c):
        return f"approx_count_distinct({c}, {rsd}D) + max(CAST({c} IS NULL AS INT))"

    return _one_row_per_column(df, columns or df.columns, {"n_distinct": ("bigint", distinct)})


def value_samples(df: DataFrame, columns: Sequence[str] | None = None, per_column: int = 6) -> DataFrame:
    """The first few values of every column in value order, numbers as numbers.

    Spark keeps only ``per_column`` rows per column and map task before the
    window's shuffle.
    """
    values = _distinct_values(df, columns or df.columns)
    numbers = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    number = F.when(F.col("column").isin(*numbers), F.col("value").try_cast("double"))
    place = F.row_number().over(Window.partitionBy("column").orderBy(number, "value"))
    return values.select("column", "value", place.alias("position")).where(
        F.col("position") <= per_column
    )


def quantiles(df: DataFrame, columns: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """Exact quantiles of several columns together, one row per column."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = numbers.unpivot([], list(columns), "column", "value")
    return ordered.quantiles(long, "value", shares, by=["column"])


def quantiles_approx(
    df: DataFrame, columns: Sequence[str], shares: dict[str, float], accuracy: int = 10_000
) -> DataFrame:
    """Sketched quantiles: one pass with a small mergeable buffer."""
    def at(share):
        return lambda c: f"percentile_approx({c}, {share}D, {accuracy})"

    return _one_row_per_column(
        df, columns, {name: ("double", at(share)) for name, share in shares.items()}
    )


def positive_rate(df: DataFrame, target: str) -> DataFrame:
    return df.selectExpr(f"avg(`{target}`) AS positive_rate")
