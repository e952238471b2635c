"""Jaccard self-join on word n-grams: size-banded tiles, bitmap bounds, exact intersections.

Sets that share none of their rarest words-in-a-row cannot be similar enough,
so rows meet only over those (the prefix filter). Where rows meet, bitmaps of
the hashed sets bound the overlap from above; what passes is decided on the
sorted arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import discard, ship, stored, whole_text
from ledgerline.llm.components import connected_components, tile_pairs

WORDS = 5
#: Links need SIMILAR[0] * intersection >= SIMILAR[1] * (sum of sizes), that is Jaccard >= 0.75.
SIMILAR = (7, 3)
#: 64-bit lanes of a bitmap signature.
LANES = 16
#: Rows compared with one another in one tile.
TILE = 1024
#: Parts that the rows of one leader are dealt into where they learn whether its groups are joined.
SALTS = 16
#: Documents sampled to learn which shingles are frequent, and how many are kept at most.
#: The order of shingles only decides how many rows meet; every order gives the same links.
SAMPLED_DOCUMENTS = 20_000
FREQUENT = 50_000
FREQUENT_FROM = 4

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``words`` words.

    A-Z count as a-z; words are separated by space, tab, line feed, vertical
    tab, form feed and carriage return. Fewer words are one shingle; none,
    none.
    """
    # Bytes are lowered and split at ASCII only; words are hashed as a whole, by a hash without linear structure.
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(word))
    runs = np.zeros(len(word) - width + 1, dtype=np.uint64)
    for i in range(width):
        runs = runs * _M2 + word[i : len(word) - width + 1 + i]
    return np.unique(_mix(runs + np.uint64(width)))


def prefix_of(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The shingles of which two sets linked must share one: rare ones first, then by hash.

    ``frequent`` is sorted by hash; its members come last.
    """
    size = len(shingles)
    length = size - (3 * size + 3) // 4 + 1 if size else 0
    if not len(frequent):
        return shingles[:length]
    at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
    common = frequent[at] == shingles
    return np.concatenate([shingles[~common], shingles[common]])[:length]


def signature(shingles: np.ndarray) -> np.ndarray:
    """Bitmap with one hashed bit per shingle, as signed 64-bit lanes."""
    bits = np.zeros(LANES * 64, dtype=np.uint8)
    bits[(shingles >> np.uint64(20)) % np.uint64(LANES * 64)] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def wide_signature(shingles: np.ndarray) -> bytes:
    """Bitmap of at least four bits per shingle, its size a power of two."""
    size = 1 << max(9, (4 * len(shingles) - 1).bit_length())
    bits = np.zeros(size, dtype=np.uint8)
    bits[(shingles >> np.uint64(20)) & np.uint64(size - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def wide_bound(x: bytes, y: bytes, x_size: int, y_size: int) -> int:
    """Upper bound of the overlap; the longer bitmap is folded to the shorter."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    size = min(len(a), len(b))
    a = np.bitwise_or.reduce(a.reshape(-1, size), axis=0)
    b = np.bitwise_or.reduce(b.reshape(-1, size), axis=0)
    return min(x_size - int(np.bitwise_count(a & ~b).sum()), y_size - int(np.bitwise_count(b & ~a).sum()))


def set_id(shingles: np.ndarray, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes(), seed=seed) - (1 << 63)


def bound(a: str, b: str) -> Column:
    """Upper bound of two sets' overlap: a bit that only one side has is a shingle the other lacks."""
    only_a = sum((F.bit_count(F.expr(f"{a}{i} & ~{b}{i}")) for i in range(LANES)), F.lit(0))
    only_b = sum((F.bit_count(F.expr(f"{b}{i} & ~{a}{i}")) for i in range(LANES)), F.lit(0))
    return F.least(F.col(f"{a}_n") - only_a, F.col(f"{b}_n") - only_b)


def frequent_shingles(rows: DataFrame, words: int) -> np.ndarray:
    """Shingles that several documents of a bounded sample share, sorted by hash."""
    total = max(rows.count(), 1)
    share = int(min(1.0, SAMPLED_DOCUMENTS / total) * (1 << 30))
    sample = rows.where(F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1 << 30)) < share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle_set(text.as_py(), words).view(np.int64))], ["h"])

    counts = sample.mapInArrow(run, "h bigint").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    top = counts.where(F.col("n") >= FREQUENT_FROM).orderBy(F.desc("n"), "h").limit(FREQUENT)
    return np.sort(top.select("h").toPandas()["h"].to_numpy(dtype=np.int64).view(np.uint64))


def set_rows(rows: DataFrame, frequent: np.ndarray, words: int) -> DataFrame:
    """One row per document, and one per shingle of its set's prefix.

    Document rows hold id, set size ``n``, two hashes ``s`` and ``s2`` of the
    set, bitmap lanes and the ``wide`` bitmap; ``h`` is NULL. Prefix rows hold
    ``h`` and ``s``; equal sets within one task give them once, and rows with a
    NULL id none.
    """
    shared = rows.sparkSession.sparkContext.broadcast(frequent)  # at most FREQUENT hashes
    lanes = [f"g{i}" for i in range(LANES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                yield from part(batch.slice(start, 1000), seen)

    def part(batch, seen):
        sizes, first, second, maps, wides, hashes, sets = [], [], [], [], [], [], []
        for known, text in zip(batch.column(0).is_valid().to_pylist(), batch.column(1)):
            shingles = shingle_set(text.as_py(), words)
            own = set_id(shingles)
            sizes.append(len(shingles))
            first.append(own)
            second.append(set_id(shingles, 1))
            maps.append(signature(shingles))
            wides.append(wide_signature(shingles))
            if known and len(shingles) and own not in seen:
                seen.add(own)
                prefix = prefix_of(shingles, shared.value)
                hashes.append(prefix.view(np.int64))
                sets.append(np.full(len(prefix), own, dtype=np.int64))
        grid = np.array(maps).reshape(-1, LANES)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.nulls(len(sizes), pa.int64()),
             *[pa.array(x, pa.int64()) for x in (first, second, sizes)],
             *[pa.array(np.ascontiguousarray(grid[:, i])) for i in range(LANES)],
             pa.array(wides, pa.binary())], names)
        if hashes:
            count = sum(map(len, hashes))
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(count, batch.column(0).type), pa.array(np.concatenate(hashes)),
                 pa.array(np.concatenate(sets)), *[pa.nulls(count, pa.int64())] * (2 + LANES),
                 pa.nulls(count, pa.binary())], names)

    names = ["_id", "h", "s", "s2", "n", *lanes, "wide"]
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, h bigint, s bigint, s2 bigint, n bigint, "
    schema += ", ".join(f"{g} bigint" for g in lanes) + ", wide binary"
    return rows.select("_id", "_text").mapInArrow(run, schema)


def _may_link(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose sizes, lanes and then wide bitmaps allow the similarity."""
    scale, least = SIMILAR
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(
            F.col("s").alias(side), F.col("n").alias(f"{side}_n"), F.col("wide").alias(f"{side}_wide"),
            *[F.col(f"g{i}").alias(f"{side}{i}") for i in range(LANES)]), side)
    fits = F.lit(scale) * bound("a", "b") >= F.lit(least) * (F.col("a_n") + F.col("b_n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([
                scale * wide_bound(x, y, m, n) >= least * (m + n)
                for m, n, x, y in zip(*[batch.column(i).to_pylist() for i in range(2, 6)])], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], ["a", "b"])

    rows = pairs.where(fits).select("a", "b", "a_n", "b_n", "a_wide", "b_wide")
    return rows.mapInArrow(run, "a bigint, b bigint")


def _arrays(rows: DataFrame, profile: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Each wanted set and its shingles, sorted as signed numbers."""
    carrier = profile.join(wanted, "s", "left_semi").groupBy("s").agg(F.min("_id").alias("_id"))
    texts = rows.join(carrier, "_id").select("s", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                found = [shingle_set(t.as_py(), words) for t in part.column(1)]
                own = [i for i, s in enumerate(part.column(0).to_pylist()) if set_id(found[i]) == s]
                arrays = [np.sort(found[i].view(np.int64)) for i in own]
                offsets = np.cumsum([0, *[len(x) for x in arrays]])
                joined = np.concatenate([np.zeros(0, np.int64), *arrays])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(joined))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(own, pa.int64())), lists], ["s", "shingles"])

    return texts.mapInArrow(run, "s bigint, shingles array<bigint>")


def _verified(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """Pairs whose sorted arrays overlap enough."""
    scale, least = SIMILAR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = batch.column(2)[i].values.to_numpy(), batch.column(3)[i].values.to_numpy()
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                common = int((x[at] == y).sum())
                keep.append(scale * common >= least * (len(x) + len(y)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["a", "b"])

    left = arrays.select(F.col("s").alias("a"), F.col("shingles").alias("_x"))
    right = arrays.select(F.col("s").alias("b"), F.col("shingles").alias("_y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "_x", "_y")
    return joined.mapInArrow(run, "a bigint, b bigint")


def _one_of_equal_groups(meeting: DataFrame) -> DataFrame:
    """Of the shingles that exactly the same sets share, keep one; shingles of a single set go.

    A shared passage has many shingles and one group of sets: without this
    every pair of the group would meet once for each of them. Groups are
    compared by their size and 128 bits of hashes of their members.
    """
    groups = meeting.groupBy("h").agg(
        F.bit_xor(F.xxhash64("s")).alias("_x"), F.bit_xor(F.xxhash64("s", F.lit(1))).alias("_y"),
        F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return meeting.join(groups.groupBy("_x", "_y", "_n").agg(F.min("h").alias("h")).select("h"), "h", "left_semi")


def _own_shingles(meeting: DataFrame, sizes: DataFrame) -> DataFrame:
    """How many shingles of its prefix each set shares with no other."""
    size = F.col("n")
    prefix = size - F.floor((3 * size + 3) / 4) + 1
    met = meeting.groupBy("s").agg(F.count(F.lit(1)).alias("_met"))
    return met.join(sizes, "s").select("s", (prefix - F.col("_met")).alias("_own"))


def _leaders(meeting: DataFrame, own: DataFrame) -> DataFrame:
    """For each shingle the set that the others are first compared with.

    It is the one with the fewest shingles of its own in its prefix: what all
    copies of a text derive from has none, while two edited copies may be too
    far apart to link.
    """
    ranked = meeting.join(own, "s").groupBy("h").agg(F.min(F.struct("_own", "s")).alias("_best"))
    return ranked.select("h", F.col("_best.s").alias("lead"))


def _merged(groups: DataFrame) -> DataFrame:
    """Join the groups of shingles with the same leader where that makes fewer pairs.

    The shingles of one passage have nearly the same sets each, so that two
    sets would meet over every one of them. ``groups`` has ``h``, ``lead``,
    ``s`` and ``c``. Sets that were in a group together stay so; ``h`` becomes
    the leader in joined groups, which ``joined`` marks. A leader may have a
    third of all rows, so the look-up of its choice is salted; only leaders
    whose groups are joined are repeated for it.
    """
    each = groups.groupBy("lead", "h").agg(F.count(F.lit(1)).alias("_k"))
    apart = each.groupBy("lead").agg(F.sum(F.col("_k") * F.col("_k")).alias("_apart"))
    joined = groups.select("lead", "s").distinct().groupBy("lead").agg(F.count(F.lit(1)).alias("_m"))
    choice = apart.join(joined, "lead").where(F.col("_m") * F.col("_m") < F.col("_apart")).select(
        "lead", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"), F.lit(True).alias("joined"))
    salted = groups.withColumn("_salt", F.pmod(F.xxhash64("s"), F.lit(SALTS)).cast("int"))
    chosen = salted.join(choice, ["lead", "_salt"], "left").withColumn("joined", F.coalesce("joined", F.lit(False)))
    return chosen.select(
        F.when(F.col("joined"), F.col("lead")).otherwise(F.col("h")).alias("h"), "joined", "s", "c").distinct()


def _crossing(meeting: DataFrame, leads: DataFrame, sets: DataFrame, part: DataFrame) -> DataFrame:
    """Pairs that meet over a shingle, lie in different components and may link.

    Rows meet in tiles of neighbouring size bands: sets whose sizes differ by
    more than the similarity allows never meet.
    """
    labelled = meeting.join(part, "s", "left").withColumn("c", F.coalesce("component", "s")).drop("component")
    mixed = labelled.groupBy("h").agg(F.min("c").alias("_lo"), F.max("c").alias("_hi")).where("_lo <> _hi")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3))).cast("int")
    groups = stored(labelled.join(mixed.select("h").join(leads, "h"), "h"), "mixed-sets")
    banded = stored(
        _merged(groups).join(sets, "s")
        .withColumn("_own", band)
        .withColumn("_band", F.explode(F.array(F.col("_own"), F.col("_own") - 1))),
        "banded-sets",
    )
    discard(groups)
    tiles = stored(tile_pairs(banded, ["h", "joined", "_band"], F.xxhash64("s"), TILE), "tiled-sets")
    discard(banded)
    keys = ["h", "joined", "_band", "_low", "_high"]
    sides = {}
    for side in ("a", "b"):
        sides[side] = tiles.select(
            *keys, F.col("s").alias(side), F.col("c").alias(f"{side}_c"), F.col("n").alias(f"{side}_n"),
            (F.col("_own") == F.col("_band")).alias(f"{side}_here"), F.col("_tile").alias(f"{side}_tile"),
            *[F.col(f"g{i}").alias(f"{side}{i}") for i in range(LANES)])
    scale, least = SIMILAR
    may = F.expr("a_c <> b_c AND a_here AND (NOT b_here OR a < b) AND (_low = _high OR a_tile <> b_tile)")
    fits = F.lit(scale) * bound("a", "b") >= F.lit(least) * (F.col("a_n") + F.col("b_n"))
    met = sides["a"].where("a_here").join(sides["b"], keys).where(may & fits)
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = stored(pairs, "meeting-pairs")
    discard(tiles)
    return pairs


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS
) -> DataFrame:
    """One row per input row: id, ``n_shingles`` and ``component_id``.

    Two rows link when the Jaccard similarity of their sets is at least 0.75;
    ``component_id`` is the smallest id reachable by links. NULL, empty and
    blank texts have empty sets and link with nothing. Equal sets are one
    class from the start. Rows with a NULL id link with nothing and have a NULL
    ``component_id``. No rows in, no rows out.

    Classes that meet over a shingle are first compared with a leader among
    them. Those that are still apart then meet in tiles; only pairs in
    different components are looked at, so a large group of near copies costs
    its size, not its square. Neither step drops a link between components.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    known = rows.where(F.col("_id").isNotNull())
    table = stored(set_rows(rows, frequent_shingles(known, words), words), "sets")
    profile = stored(table.where("h IS NULL").drop("h"), "set-profiles")
    prefixes = table.where("h IS NOT NULL").select("h", "s")
    repeated = prefixes.groupBy("h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("h")
    repeated = stored(repeated, "shared-shingles")
    shared = stored(prefixes.join(repeated.hint("shuffle_hash"), "h").distinct(), "sharing-sets")
    discard(table, repeated)
    meeting = stored(_one_of_equal_groups(shared), "meeting-sets")
    compared = profile.where("n > 0").join(meeting.select("s").distinct(), "s", "left_semi")
    sets = stored(compared.groupBy("s").agg(
        *[F.max(c).alias(c) for c in ("n", "wide", *[f"g{i}" for i in range(LANES)])]), "compared-sets")

    leads = stored(_leaders(meeting, _own_shingles(shared, sets.select("s", "n"))), "leaders")
    discard(shared)
    stars = meeting.join(leads, "h").where("s <> lead").select(
        F.least("lead", "s").alias("a"), F.greatest("lead", "s").alias("b")).distinct()
    pairs = stored(_may_link(stars, sets), "star-pairs")
    ends = pairs.select(F.col("a").alias("s")).unionByName(pairs.select(F.col("b").alias("s"))).distinct()
    arrays = stored(_arrays(known, profile, ends, words), "shingle-arrays")
    links = stored(_verified(pairs, arrays), "star-links")
    part = connected_components(links, "a", "b").select(F.col("id").alias("s"), "component")

    apart = _crossing(meeting, leads, sets.drop("wide"), part).join(pairs, ["a", "b"], "left_anti")
    crossing = stored(_may_link(apart, sets), "crossing-pairs")
    if not crossing.isEmpty():
        ends = crossing.select(F.col("a").alias("s")).unionByName(crossing.select(F.col("b").alias("s"))).distinct()
        missing = ends.join(arrays, "s", "left_anti")
        arrays = arrays.unionByName(stored(_arrays(known, profile, missing, words), "more-arrays"))
        more = stored(_verified(crossing, arrays), "crossing-links")
        part = connected_components(links.unionByName(more), "a", "b").select(F.col("id").alias("s"), "component")

    # Rows without a set get a key of their own, which spreads them evenly.
    labelled = profile.join(part, "s", "left").withColumn(
        "_class", F.when(F.col("n") > 0, F.coalesce("component", "s")).otherwise(F.xxhash64("_id")))
    least = stored(
        labelled.where("n > 0").groupBy("_class").agg(
            F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_rows")).where("_rows > 1"),
        "least-ids")
    joined = labelled.join(least, "_class", "left")
    component = F.when((F.col("n") > 0) & F.col("_id").isNotNull(), F.coalesce("_least", "_id")).otherwise(F.col("_id"))
    return joined.select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
