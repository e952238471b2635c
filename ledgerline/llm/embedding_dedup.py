"""Near-duplicate embeddings: cross-polytope hashing after fast Hadamard rotations, multiprobe.

A rotation is three rounds of random signs and a fast Hadamard transform. The
hash is the axis, with sign, that the rotated vector is closest to. Vectors
that share a bucket of some table are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import discard, ship, stored
from ledgerline.llm.components import connected_components, tile_pairs

LEAST_COSINE = 0.9
#: Vectors expected in a bucket; the hashes joined into one bucket number follow from it.
BUCKET_ROWS = 8
#: Tables, and buckets a vector goes to in each (its own and the next likely ones), by the hashes
#: joined: more hashes part more neighbours. Pairs at cosine 0.9 found in 64 and 128 dimensions:
#: all, 0.999, all and all of them (400 to 1,500 pairs each).
EFFORT = {1: (12, 2), 2: (12, 2), 3: (24, 4), 4: (32, 8)}
#: Vectors compared with one another in one tile.
TILE = 1024
SEED = 20_011


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal fast Hadamard transform of each row; the width is a power of two."""
    rows, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(rows, -1, 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        half *= 2
    return x.reshape(rows, width) / math.sqrt(width)


def rotation_signs(table: int, function: int, width: int) -> np.ndarray:
    return np.random.default_rng([SEED, table, function]).choice([-1.0, 1.0], size=(3, width))


def polytope_hashes(x: np.ndarray, signs: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``probes`` closest signed axes of each row, and how much farther each is than the first."""
    for s in signs:
        x = hadamard(x * s)
    size = np.abs(x)
    order = np.argsort(-size, axis=1, kind="stable")[:, :probes]
    best = np.take_along_axis(size, order, axis=1)
    negative = np.take_along_axis(x, order, axis=1) < 0
    return 2 * order + negative, (best[:, :1] - best) ** 2


def probe_buckets(x: np.ndarray, table: int, functions: int, probes: int) -> np.ndarray:
    """Bucket numbers of each row in one table: the own one first, then by closeness."""
    width = x.shape[1]
    choices = min(probes, width)
    hashes, gaps = zip(*[
        polytope_hashes(x, rotation_signs(table, f, width), choices) for f in range(functions)])
    buckets, costs = np.zeros((len(x), 1), dtype=np.int64), np.zeros((len(x), 1))
    for h, g in zip(hashes, gaps):
        buckets = (buckets[:, :, None] * (2 * width) + h[:, None, :]).reshape(len(x), -1)
        costs = (costs[:, :, None] + g[:, None, :]).reshape(len(x), -1)
        order = np.argsort(costs, axis=1, kind="stable")[:, :probes]
        buckets, costs = np.take_along_axis(buckets, order, axis=1), np.take_along_axis(costs, order, axis=1)
    return buckets


def functions_for(vectors: int, width: int) -> int:
    """Hashes per bucket number, so that buckets hold a few vectors at every size."""
    return max(1, min(4, round(math.log(max(vectors / BUCKET_ROWS, 2)) / math.log(2 * width))))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows padded with zeros and scaled to length one, in double precision."""
    x = np.zeros((len(column), width))
    for i, vector in enumerate(column):
        values = vector.values.to_numpy(zero_copy_only=False)
        x[i, : len(values)] = values
    return unit(x)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaling by the largest component first keeps the squares finite."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def with_buckets(classes: DataFrame, width: int, functions: int, tables: int, probes: int) -> DataFrame:
    """The classes with their bucket numbers, those of one table after those of another."""
    kinds = {c: classes.schema[c].dataType.simpleString() for c in ("id", "vector")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(2), width)
                found = np.hstack([probe_buckets(x, table, functions, probes) for table in range(tables)])
                starts = pa.array(np.arange(len(x) + 1) * found.shape[1], pa.int32())
                lists = pa.ListArray.from_arrays(starts, pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["id", "copies", "vector", "buckets"])

    schema = f"id {kinds['id']}, copies bigint, vector {kinds['vector']}, buckets array<bigint>"
    return classes.select("id", "copies", "vector").mapInArrow(run, schema)


def first_shared(a: np.ndarray, b: np.ndarray, buckets: np.ndarray, table: int, bucket: int) -> np.ndarray:
    """Which pairs share no bucket before this one, by table and then number.

    ``a`` and ``b`` are row numbers of ``buckets`` (row, table, probe).
    """
    left = np.arange(len(a))
    for earlier in range(table + 1):
        x, y = buckets[a[left], earlier], buckets[b[left], earlier]
        shared = np.zeros(len(left), dtype=bool)
        for i in range(x.shape[1]):
            same = (y == x[:, i : i + 1]).any(axis=1)
            shared |= same & (x[:, i] < bucket) if earlier == table else same
        left = left[~shared]
    keep = np.zeros(len(a), dtype=bool)
    keep[left] = True
    return keep


def spanning(rows: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of the rows the smallest one that pairs lead to."""
    least = np.arange(rows)
    while True:
        before = least.copy()
        np.minimum.at(least, a, before[b])
        np.minimum.at(least, b, before[a])
        least = least[least]
        if (least == before).all():
            return least


def _links(hashed: DataFrame, width: int, tables: int, least: float) -> DataFrame:
    """What the classes that share a bucket and have the cosine say of one another.

    Rows with ``n`` say how many rows the classes hold that ``a`` links with in
    one tile; the others name two classes, ``a`` and ``b``, that links join.
    A pair counts in the first bucket that it shares alone, and the pairs of a
    tile are joined by fewer rows than the tile has, so that a dense cluster
    makes as many rows as its tiles have and not as many as it has pairs.
    Rows of a tile lie together in a sorted partition; a task holds one tile
    and one batch at a time.
    """
    keys = ["table", "bucket", "_low", "_high"]
    each = F.expr(f"size(buckets) div {tables}")
    placed = hashed.select("id", each.alias("_each"), F.posexplode("buckets").alias("_place", "bucket")).select(
        F.expr("cast(_place div _each as int)").alias("table"), "bucket", "id")
    tiles = tile_pairs(placed, ["table", "bucket"], F.xxhash64("id"), TILE)
    together = tiles.join(hashed, "id").repartition(*keys).sortWithinPartitions(*keys, "id")
    kind = hashed.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            grid = np.column_stack([batch.column(i).to_numpy() for i in range(4)]).astype(np.int64)
            ids, arrow_kind = batch.column(5).to_numpy(zero_copy_only=False), batch.column(5).type
            buckets = batch.column(8).flatten().to_numpy().reshape(batch.num_rows, tables, -1)
            new = [grid, batch.column(4).to_numpy(), ids, batch.column(6).to_numpy(),
                   _matrix(batch.column(7), width), buckets]
            held = new if held is None else [np.concatenate(two) for two in zip(held, new)]
            starts = np.flatnonzero(np.r_[True, (held[0][1:] != held[0][:-1]).any(axis=1)])
            yield from found(held, starts, starts[1:], arrow_kind)
            held = [x[starts[-1]:] for x in held]
        if held is not None:
            yield from found(held, [0], [len(held[0])], arrow_kind)

    def found(held, starts, ends, arrow_kind):
        for i, j in zip(starts, ends):
            if j - i > 1:
                (table, bucket, low, high), *columns = held[0][i], *[x[i:j] for x in held[1:]]
                yield from compared(table, bucket, low != high, *columns, arrow_kind)

    def compared(table, bucket, split, tile, ids, copies, x, buckets, arrow_kind):
        a, b = np.nonzero(np.triu(x @ x.T >= least, 1))
        if split:
            apart = tile[a] != tile[b]
            a, b = a[apart], b[apart]
        first = first_shared(a, b, buckets, table, bucket)
        a, b = a[first], b[first]
        if len(a):
            others = np.zeros(len(ids), dtype=np.int64)
            np.add.at(others, a, copies[b])
            np.add.at(others, b, copies[a])
            met = np.flatnonzero(others)
            centre = spanning(len(ids), a, b)
            moved = np.flatnonzero(centre != np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[met], arrow_kind), pa.nulls(len(met), arrow_kind), pa.array(others[met])], ["a", "b", "n"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[moved], arrow_kind), pa.array(ids[centre[moved]], arrow_kind),
                 pa.nulls(len(moved), pa.int64())], ["a", "b", "n"])

    columns = together.select(*keys, "_tile", "id", "copies", "vector", "buckets")
    return columns.mapInArrow(run, f"a {kind}, b {kind}, n bigint")


def near_duplicate_vectors(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    least: float = LEAST_COSINE, functions: int | None = None, tables: int | None = None, probes: int | None = None,
) -> DataFrame:
    """One row per input row: id, ``n_links``, ``component_id`` and ``kept``.

    Rows link when their cosine is at least ``least``. ``component_id`` is the
    smallest id reachable by links, and ``kept`` says that it is the row's own.
    Vectors that are NULL, empty or zero, or hold a NULL or non-finite
    component, link with nothing, and so do rows with a NULL id. Shorter
    vectors count as padded with zeros. Equal vectors are one class: its rows
    link without being paired. Repeated rows count as rows of their class. No
    rows in, no rows out.

    Every link reported is verified in double precision. Of all links, tables
    and probes find nearly all at every number of hashes (``EFFORT`` and the recall tests);
    the number follows from that of the vectors unless given. Crowded buckets are
    compared whole, in tiles; of the pairs found only counts and the joined
    components leave a tile.
    """
    ship(embeddings.sparkSession)
    vector = F.col("_vector")
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    sound = F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))
    rows = embeddings.select(
        F.col(id_col).alias("_id"), F.col(vector_col).alias("_vector"))
    linked = rows.where(sound & F.col("_id").isNotNull())
    classes = stored(
        linked.groupBy(vector.alias("vector")).agg(F.min("_id").alias("id"), F.count(F.lit(1)).alias("copies")),
        "vectors")
    facts = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("d")).first()
    width = 1 << max(0, (max(facts["d"] or 1, 1) - 1).bit_length())
    functions = functions or functions_for(facts["n"], width)
    effort = EFFORT[functions]
    tables = tables or effort[0]
    hashed = stored(with_buckets(classes, width, functions, tables, probes or effort[1]), "buckets")
    links = stored(_links(hashed, width, tables, least), "vector-links")
    discard(hashed)
    counted = links.where("n IS NOT NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("_others"))
    part = connected_components(links.where("n IS NULL"), "a", "b")
    labelled = stored(
        classes.join(counted, "id", "left").join(part, "id", "left").select(
            F.col("vector").alias("_vector"), F.coalesce("component", "id").alias("_component"),
            (F.coalesce("_others", F.lit(0)) + F.col("copies") - 1).alias("_links")),
        "vector-classes")
    known = linked.join(labelled, "_vector").select(
        F.col("_id"), F.col("_links").cast("long").alias("n_links"), F.col("_component").alias("component_id"))
    alone = rows.where(~(sound & F.col("_id").isNotNull())).select(
        "_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    return known.unionByName(alone).select(
        F.col("_id").alias(id_col), "n_links", "component_id",
        F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))
