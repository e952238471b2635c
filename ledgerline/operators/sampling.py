"""Seeded samples and splits that depend on row keys, not on file layout."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline import schemas
from ledgerline.functions.columns import hash_point, key_hash
from ledgerline.session import fresh_dir
from ledgerline.sources.files import store

CELL_DIGITS = 4


def _position(key: str, seed: int) -> Column:
    """Total order by hash, then by key."""
    return F.struct(key_hash(key, seed).alias("h"), F.col(key).alias("k"))


def _edges(rows: DataFrame, by: Sequence[str], digits: int, want: Callable[[Column], Column]) -> DataFrame:
    """Per group the hash prefix that holds the last wanted row, and how many of its rows are still wanted."""
    group = Window.partitionBy(*by)
    cells = rows.groupBy(*by, F.substring("_at.h", 1, digits).alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    cells = cells.select(
        *by, "_cell", "_n",
        F.sum("_n").over(group.orderBy("_cell")).alias("_through"),
        want(F.sum("_n").over(group)).alias("_want"),
    )
    before = F.col("_through") - F.col("_n")
    return cells.where((before < F.col("_want")) & (F.col("_want") <= F.col("_through"))).select(
        *by, "_cell", (F.col("_want") - before).alias("_left")
    )


def _inside(rows: DataFrame, by: Sequence[str], digits: int, edges: DataFrame) -> DataFrame:
    # One row per group, and groups are a declared handful.
    return rows.withColumn("_cell", F.substring("_at.h", 1, digits)).join(F.broadcast(edges), [*by, "_cell"]).drop("_cell")


def _cutoffs(
    df: DataFrame, key: str, want: Callable[[Column], Column], seed: int, by: Sequence[str] = ()
) -> DataFrame:
    """Position of the last row to keep per group: exactly ``want(total)`` rows lie up to it.

    Hashes are counted in 16**4 cells, which names the cell holding the cut
    and how many of its rows are still wanted. The rows of that cell, a
    65,536th of the group, are stored and cut the same way once more, so that
    only a 65,536th of them is ordered row by row.
    """
    spark = df.sparkSession
    keyed = df.select(*by, _position(key, seed).alias("_at"))
    near = store(
        _inside(keyed, by, CELL_DIGITS, _edges(keyed, by, CELL_DIGITS, want)).withColumnRenamed("_left", "_rest"),
        fresh_dir(spark, "edge-cell"))
    # Grouped by the rest as well, which is one number per group.
    rest = [*by, "_rest"]
    edges = _edges(near, rest, 2 * CELL_DIGITS, lambda _: F.col("_rest"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_at"))
    last = _inside(near, rest, 2 * CELL_DIGITS, edges).withColumn("_place", place).where("_place = _left")
    return last.select(*by, F.col("_at").alias("_cut"))


def exact_sample(df: DataFrame, n: int, key: str, seed: int = schemas.SEED) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer) without replacement."""
    cut = _cutoffs(df, key, lambda total: F.least(F.lit(n), total), seed)
    return df.where(_position(key, seed) <= cut.scalar())


def fraction_sample(df: DataFrame, fraction: float, key: str, seed: int = schemas.SEED) -> DataFrame:
    """Each row kept with the given chance: a filter, with no shuffle."""
    return df.where(key_hash(key, seed) < hash_point(fraction))


def random_split(
    df: DataFrame, fraction: float, key: str, seed: int = schemas.SEED
) -> tuple[DataFrame, DataFrame]:
    """Independent row-wise split; a row's side never changes on recomputation."""
    chosen = key_hash(key, seed) < hash_point(fraction)
    return df.where(chosen), df.where(~chosen)


def stratified_split(
    df: DataFrame, fraction: float, key: str, label: str, levels: Sequence,
    seed: int = schemas.SEED,
) -> tuple[DataFrame, DataFrame]:
    """Split that takes the same share, to the row, of every label level.

    Rows whose label is NULL or not listed go to the second part.
    """
    cuts = _cutoffs(
        df.where(F.col(label).isin(*levels)), key,
        lambda total: F.floor(F.lit(fraction) * total + 0.5), seed, [label],
    )
    cuts = store(cuts, fresh_dir(df.sparkSession, "cuts"))  # both parts read the handful of positions
    # At most one row per listed level.
    marked = df.join(F.broadcast(cuts), label, "left").withColumn(
        "_first", F.coalesce(_position(key, seed) <= F.col("_cut"), F.lit(False))
    ).select(*df.columns, "_first")
    first = marked.where("_first").drop("_first")
    return first, marked.where(~F.col("_first")).drop("_first")
