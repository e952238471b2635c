"""Shards of even size: sampled splitters, range partitioning, subdivision of overfull ranges."""

from __future__ import annotations

import bisect
import heapq
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerline.llm.common import ship, stored, whole_text

#: Ranges made for each shard, so that whole ranges can balance the shards.
RANGES_PER_SHARD = 64
#: Beyond it a range of the whole table is cut in more, so that one task can order it.
RANGE_BYTES = 1 << 30
#: Expected sampled keys for each range.
SAMPLE_PER_RANGE = 16
#: A range with over this many times its share is subdivided.
OVERFULL = 2.0
#: Rounds of subdivision.
ROUNDS = 4

Splitter = tuple[int, int]  # (text hash, id); ranges begin at a splitter
FIRST_ID = -(1 << 63)


class Range(NamedTuple):
    number: int
    size: int
    rows: int


def _sample(keys: DataFrame, budget: int, total: int) -> list[tuple[int, int, float]]:
    """About ``budget`` keys, drawn with a chance in proportion to their size.

    The draw follows a hash of the key, so a repeated task draws the same.
    Returns (hash, id, weight): what each drawn key stands for.
    """
    rate = budget / max(total, 1)
    draw = F.pmod(F.xxhash64("_hash", "_id", F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
    drawn = keys.where(draw < F.col("size") * rate).select("_hash", "_id", "size")
    return sorted((r[0], r[1], max(float(r[2]), 1 / rate)) for r in drawn.collect())


def _cut(sample: list[tuple[int, int, float]], parts: int) -> list[Splitter]:
    """Quantile boundaries of the weighted sample.

    A boundary moves to the start of its group of equal hashes, unless the
    group alone fills a part: such a group gets a range of its own, which is
    cut by id.
    """
    if not sample or parts < 2:
        return []
    weights = np.cumsum([w for _, _, w in sample])
    share = weights[-1] / parts
    group: dict[int, float] = {}
    for key, _, weight in sample:
        group[key] = group.get(key, 0.0) + weight
    cuts: set[Splitter] = set()
    for at in np.searchsorted(weights, share * np.arange(1, parts)):
        key, row, _ = sample[min(int(at), len(sample) - 1)]
        if group[key] < share:
            cuts.add((key, FIRST_ID))
        else:
            cuts |= {(key, FIRST_ID), (key, row)}
            if key < (1 << 63) - 1:
                cuts.add((key + 1, FIRST_ID))
    return sorted(cuts)


def _with_range(keys: DataFrame, splitters: list[Splitter]) -> DataFrame:
    """Add ``_range``: how many splitters are at or before the row's key."""
    hashes = np.array([s[0] for s in splitters], dtype=np.int64)

    @F.pandas_udf("int")
    def place(key: pd.Series, row: pd.Series) -> pd.Series:
        low = np.searchsorted(hashes, key.to_numpy(), "left")
        high = np.searchsorted(hashes, key.to_numpy(), "right")
        ids = row.to_numpy()
        values = key.to_numpy()
        for i in np.nonzero(high > low)[0]:
            low[i] = bisect.bisect_right(splitters, (int(values[i]), int(ids[i])))
        return pd.Series(low.astype("int32"))

    return keys.withColumn("_range", place("_hash", "_id"))


def _measured(keys: DataFrame, splitters: list[Splitter]) -> list[Range]:
    sums = _with_range(keys, splitters).groupBy("_range").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    return sorted(Range(r[0], r[1], r[2]) for r in sums.collect())


def splitters_of(keys: DataFrame, total: int, ranges: int) -> tuple[list[Splitter], list[Range]]:
    """Splitters and measured ranges; overfull ranges are sampled again and cut finer."""
    splitters = _cut(_sample(keys, SAMPLE_PER_RANGE * ranges, total), ranges)
    share = total / ranges
    for left in reversed(range(ROUNDS)):
        measured = _measured(keys, splitters)
        full = [r for r in measured if r.size > OVERFULL * share and r.rows > 1]
        if not full or not left:
            return splitters, measured
        within = _with_range(keys, splitters).where(F.col("_range").isin([r.number for r in full]))
        size = sum(r.size for r in full)
        sample = _sample(within, SAMPLE_PER_RANGE * max(2, round(2 * size / share)), size)
        added: set[Splitter] = set()
        for r in full:
            low = splitters[r.number - 1] if r.number else (FIRST_ID, FIRST_ID)
            high = splitters[r.number] if r.number < len(splitters) else (1 << 63, 0)
            own = [s for s in sample if low <= s[:2] < high]
            added |= {c for c in _cut(own, max(2, round(2 * r.size / share))) if low < c < high}
        if added <= set(splitters):
            return splitters, measured
        splitters = sorted({*splitters, *added})
    return splitters, measured


def _dealt(splitters: list[Splitter], measured: list[Range], shards: int) -> list[tuple]:
    """(range, shard, offset): whole groups to the emptiest shard, largest first.

    Ranges that continue a group of equal texts go with it, unless the group
    is larger than a shard.
    """
    share = sum(r.size for r in measured) / shards
    units: list[list[Range]] = []
    heads: list[int | None] = []
    for r in measured:
        before = splitters[r.number - 1] if r.number else None
        continues = before is not None and before[1] != FIRST_ID
        key = before[0] if before is not None else None
        if continues and units and heads[-1] == key and sum(x.size for x in units[-1]) + r.size <= share:
            units[-1].append(r)
        else:
            units.append([r])
            heads.append(key)
    loads = [(0, s) for s in range(shards)]
    shard_of: dict[int, int] = {}
    for unit in sorted(units, key=lambda u: (-sum(r.size for r in u), u[0].number)):
        load, shard = heapq.heappop(loads)
        heapq.heappush(loads, (load + sum(r.size for r in unit), shard))
        shard_of |= {r.number: shard for r in unit}
    offsets = [0] * shards
    dealt = []
    for r in measured:
        dealt.append((r.number, shard_of[r.number], offsets[shard_of[r.number]]))
        offsets[shard_of[r.number]] += r.rows
    return dealt


def _lookup(spark: SparkSession, dealt: list[tuple]) -> DataFrame:
    return spark.createDataFrame(pd.DataFrame(dealt, columns=["_range", "shard", "_offset"]).astype(
        {"_range": "int32", "shard": "int32", "_offset": "int64"}))


def shard_documents(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
    ranges_per_shard: int = RANGES_PER_SHARD,
) -> DataFrame:
    """Deal all rows into ``shards`` of nearly equal bytes (law ``bytes``).

    One row per input row: id, ``size`` (UTF-8 bytes of the text plus 1; NULL
    text has none), ``text_crc32``, ``law``, ``shard``, ``slot`` (gapless from
    0 within the shard) and ``grown_shard`` (NULL under this law). Equal texts
    have equal keys and share a shard unless they fill more than one. Ids of any
    type, NULL and repeated ones too, are only handed through: equal texts are told
    apart by their place in the input, so repeated rows take a slot each and
    are divided like any others. No rows, no shards. Only keys move: the texts are read once.

    The driver holds a sample bounded by the number of ranges, and one row per
    range. Each range is ordered by its own task; a hot text is cut by its rows' places.
    """
    spark = docs.sparkSession
    ship(spark)
    text = whole_text(text_col)
    keys = stored(docs.select(
        F.col(id_col).alias("_given"), F.monotonically_increasing_id().alias("_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_hash"),
    ), "shard-keys")
    total = keys.agg(F.sum("size").alias("n")).first()["n"] or 0
    ranges = max(shards * ranges_per_shard, total // RANGE_BYTES)
    splitters, measured = splitters_of(keys, total, ranges)
    dealt = _dealt(splitters, measured, shards) or [(0, 0, 0)]
    placed = _with_range(keys, splitters).join(F.broadcast(_lookup(spark, dealt)), "_range")
    order = Window.partitionBy("_range").orderBy("_hash", "_id")
    return placed.select(
        F.col("_given").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_offset") + F.row_number().over(order) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
