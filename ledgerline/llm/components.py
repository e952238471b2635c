"""Connected components of a link table, and tiles for comparing the members of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node points its larger neighbours to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a"), F.least("a", "_m").alias("_m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node points its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("_m"))
    moved = edges.join(least, "a").where("b > _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("_m", "b")).distinct()


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``id`` and ``component`` (smallest id reachable) of every node that has a link.

    Alternates the large and the small star until the links are stars around
    the smallest nodes, which takes about log(nodes) rounds. Every round is
    stored. Only counts and check sums reach the driver. Links of a node to
    itself and repeated links are ignored.
    """
    a, b = F.greatest(left, right), F.least(left, right)
    edges = stored(links.select(a.alias("a"), b.alias("b")).where("a > b").distinct(), "links")
    before = _state(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    centres = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(centres)


def tile_pairs(rows: DataFrame, keys: list[str], spread: Column, tile: int) -> DataFrame:
    """Repeat the rows of each group so that every two of them meet in a bounded sub-group.

    Groups with one row go. A group is dealt into tiles of about ``tile`` rows
    by ``spread`` (a hash); ``_tile`` is the row's own tile, and ``_low`` and
    ``_high`` name the two tiles that the copy is compared in.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    tiled = rows.join(sizes, keys).withColumn("_tiles", F.ceil(F.col("_n") / tile).cast("int")).withColumn(
        "_tile", F.pmod(spread, F.col("_tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))
    return tiled.select("*", other.alias("_other")).select(
        *rows.columns, "_tile", F.least("_tile", "_other").alias("_low"), F.greatest("_tile", "_other").alias("_high"))
