"""Repeated 100-byte passages by bucket-pointer refinement over sampled suffixes.

Suffixes are sampled at anchors: the place of the least q-gram hash among those
that a 100-byte string holds. Equal strings have the same anchor at the same
place. Suffixes first fall into buckets by the q-gram at their anchor. Buckets
with one member go. The rest are refined by the bucket of the stretch of text
that all strings with this anchor span; members that agree there are equal
throughout, and whatever is known of the first of them holds for the others.
Only where a bucket holds different stretches, at the ends of a match, are the
first members refined again in the same way: into blocks of neighbouring
strings, by the core that these have in common, then by the whole block, and at
last string by string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerline.llm.common import discard, ship, stored, whole_text

#: Bytes of a passage, and of the q-gram that names a bucket at first.
PASSAGE = 100
QGRAM = 32
#: Neighbouring passages whose common core is a bucket of its own.
BLOCK = 18
#: Rows a task hands over at once.
_FLUSH = 200_000
_ROWS_AT_ONCE = 16_384

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0xD6E8FEB86659FD93
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64))


def _grow(size: int) -> None:
    global _powers, _inverses
    if len(_powers) < size:
        steps = np.full(max(size, 2 * len(_powers)), _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
        steps[1:] = np.uint64(pow(_BASE, -1, 1 << 64))
        _inverses = np.cumprod(steps)


def _qgram_hashes(letters: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` (a power of two) bytes at every place, each length from two of half."""
    hashes, length = letters, 1
    while length < width:
        hashes = hashes[:-length] * np.uint64(pow(_BASE, length, 1 << 64)) + hashes[length:]
        length *= 2
    return _mix(hashes)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    length = 1
    while 2 * length <= width:
        x = np.minimum(x[:-length], x[length:])
        length *= 2
    rest = width - length
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, passage: int = PASSAGE, qgram: int = QGRAM):
    """(bucket, stretch, first, last, place) of every anchor.

    ``first`` to ``last`` are the starts of the passages whose leftmost least
    q-gram is at the anchor's ``place``; ``bucket`` is its hash, and ``stretch`` that of
    all the bytes these passages span. Each passage belongs to one anchor.
    """
    if len(data) < passage:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    letters = _BYTES[data]
    hashes = _qgram_hashes(letters, qgram)
    width = passage - qgram + 1
    least = _sliding_min(hashes, width)
    starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    ends = np.r_[starts[1:], len(least)] - 1
    steps = np.arange(width)
    firsts, lasts, places = [], [], []
    # A run of equal least hashes has one anchor, unless the q-gram itself repeats in it.
    while len(starts):
        at = np.concatenate([
            s + np.argmin(hashes[s[:, None] + steps], axis=1)
            for s in np.array_split(starts, -(-len(starts) // _ROWS_AT_ONCE))
        ])
        firsts.append(starts)
        lasts.append(np.minimum(ends, at))
        places.append(at)
        more = at < ends
        starts, ends = at[more] + 1, ends[more]
    first, last, place = (np.concatenate(x) for x in (firsts, lasts, places))
    _grow(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters * _powers[: len(data)])])
    stop = last + passage
    spanned = _mix((sums[stop] - sums[first]) * _inverses[first] + (stop - first).astype(np.uint64))
    return hashes[place].view(np.int64), spanned.view(np.int64), first, last, place


def _again(bucket: np.ndarray, stretch: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which stretches occurred earlier in the same text."""
    order = np.lexsort((first, stretch, bucket))
    same = (bucket[order][1:] == bucket[order][:-1]) & (stretch[order][1:] == stretch[order][:-1])
    again = np.zeros(len(first), dtype=bool)
    again[order[1:][same]] = True
    return again


def _bytes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), dtype=np.uint8)


def anchor_rows(texts: DataFrame, passage: int) -> DataFrame:
    """Anchors of all texts.

    ``h`` is the bucket, ``k`` the stretch, ``lo`` the first passage's start,
    ``span`` how many more follow, ``back`` how far the anchor is behind
    ``lo``; ``again`` says that the stretch occurred before in the same text.
    """
    kinds = [("h", pa.int64()), ("k", pa.int64()), ("key", pa.int64()), ("lo", pa.int32()),
             ("span", pa.int16()), ("back", pa.int16()), ("again", pa.bool_())]

    def rows_of(held):
        columns = [pa.array(np.concatenate([x[i] for x in held])).cast(kind) for i, (_, kind) in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, [name for name, _ in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                bucket, stretch, first, last, place = anchors(_bytes_of(text.as_py()), passage)
                if not len(bucket):
                    continue
                keys = np.full(len(bucket), key, dtype=np.int64)
                held.append((bucket, stretch, keys, first, last - first, place - first, _again(bucket, stretch, first)))
                count += len(bucket)
                if count > _FLUSH:
                    yield rows_of(held)
                    held, count = [], 0
        if held:
            yield rows_of(held)

    return texts.select("_key", "_text").mapInArrow(
        run, "h bigint, k bigint, key bigint, lo int, span smallint, back smallint, again boolean")


def _halves(name: int) -> tuple[int, int]:
    """A 128-bit name as two signed longs."""
    return (name >> 64) - (1 << 63), (name & ((1 << 64) - 1)) - (1 << 63)


_CORE = "c1 bigint, c2 bigint, e bigint, key bigint, at int, low smallint, high smallint, before binary, after binary"


def core_rows(texts: DataFrame, ranges: DataFrame, passage: int) -> DataFrame:
    """The passages of the ranges by blocks of ``BLOCK`` neighbours.

    A block's core (``c1``, ``c2``) is what all its passages have in common;
    ``e`` names what the block has besides. The passages lie ``low``
    to ``high`` bytes before the anchor at ``at``, and go beyond the core by
    the ends of ``before`` and the beginnings of ``after``.
    """
    listed = ranges.groupBy(F.col("key").alias("_key")).agg(
        F.collect_list(F.struct("lo", "span", "back")).alias("ranges"))
    joined = texts.join(listed, "_key").select("_key", "_text", "ranges")
    names = [field.split()[0] for field in _CORE.split(", ")]
    schema = pa.schema(list(zip(names, [
        pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16(),
        pa.binary(), pa.binary()])))

    def blocks(key, data, ranges):
        for r in ranges:
            at, farthest = r["lo"] + r["back"], r["back"]
            nearest = farthest - r["span"]
            for begin in range(nearest - nearest % BLOCK, farthest + 1, BLOCK):
                low, high = max(begin, nearest), min(begin + BLOCK - 1, farthest)
                start, stop = at - begin, at - begin - BLOCK + 1 + passage
                c1, c2 = _halves(xxhash.xxh3_128_intdigest(data[start:stop], seed=begin))
                before, after = data[at - high : start], data[stop : at - low + passage]
                whole = xxhash.xxh3_64_intdigest(before + after, seed=low * 256 + high) - (1 << 63)
                yield c1, c2, whole, key, at, low, high, before, after

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for key, text, ranges in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                held += blocks(key, text.as_py().encode(), ranges.as_py())
                if len(held) > _FLUSH:
                    yield _record(held, schema)
                    held = []
            if held:
                yield _record(held, schema)

    return joined.mapInArrow(run, _CORE)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(zip(*rows), schema)], schema=schema)


def passage_rows(cores: DataFrame) -> DataFrame:
    """(w1, w2, key, p): every passage of the blocks, named by core, place and ends."""
    schema = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("key", pa.int64()), ("p", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for c1, c2, _, key, at, low, high, before, after in zip(*[c.to_pylist() for c in batch.columns]):
                begin = low - low % BLOCK
                core = c1.to_bytes(8, "little", signed=True) + c2.to_bytes(8, "little", signed=True)
                for back in range(low, high + 1):
                    left = before[high - back :]
                    right = after[: begin + BLOCK - 1 - back]
                    name = xxhash.xxh3_128_intdigest(core + bytes([back]) + left + right)
                    held.append((*_halves(name), key, at - back))
                if len(held) > _FLUSH:
                    yield _record(held, schema)
                    held = []
            if held:
                yield _record(held, schema)

    return cores.mapInArrow(run, "w1 bigint, w2 bigint, key bigint, p int")


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, text and ``_key``, a long that orders the rows; the id itself where it can serve."""
    rows = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    simple = isinstance(rows.schema["_id"].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    ids = rows.groupBy("_id").agg(F.count(F.lit(1)).alias("n"))
    if simple and ids.where("n > 1 OR _id IS NULL").isEmpty():
        return rows.withColumn("_key", F.col("_id").cast("long"))
    ordered = rows.orderBy(F.col("_id").asc_nulls_first(), "_text")
    numbered = ordered.rdd.zipWithIndex().map(lambda x: (*x[0], x[1]))
    schema = T.StructType([*rows.schema.fields, T.StructField("_key", T.LongType())])
    return stored(docs.sparkSession.createDataFrame(numbered, schema), "numbered")


def repeated_starts(texts: DataFrame, passage: int) -> DataFrame:
    """Ranges of the starts of passages that also start earlier, by text: ``_key`` and ``starts``."""
    every = stored(anchor_rows(texts, passage), "anchors")
    shared = stored(
        every.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "shared-buckets")
    members = stored(every.join(shared.hint("shuffle_hash"), "h"), "bucket-members")
    discard(every, shared)

    stretches = stored(members.groupBy("h", "k").agg(F.min("key").alias("first")), "stretches")
    mixed = stretches.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    repeats = F.col("again") | (F.col("first") < F.col("key"))
    judged = stored(members.join(stretches, ["h", "k"]).withColumn("repeats", repeats), "judged-members")
    discard(members)
    by_stretch = judged.where("repeats").select("key", "lo", (F.col("lo") + F.col("span")).alias("hi"))

    ends = judged.where("NOT repeats").join(mixed, "h", "left_semi").select("key", "lo", "span", "back")
    cores = stored(core_rows(texts, ends, passage), "cores")
    place = F.struct("key", "at")
    blocks = stored(cores.groupBy("c1", "c2", "e").agg(F.min(place).alias("first")), "blocks")
    several = blocks.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("c1", "c2")
    parts = stored(
        cores.join(blocks, ["c1", "c2", "e"]).withColumn("repeats", place > F.col("first")), "judged-blocks")
    discard(cores)
    by_block = parts.where("repeats").select(
        "key", (F.col("at") - F.col("high")).alias("lo"), (F.col("at") - F.col("low")).alias("hi"))

    left = parts.where("NOT repeats").join(several, ["c1", "c2"], "left_semi")
    names = [field.split()[0] for field in _CORE.split(", ")]
    singles = stored(passage_rows(left.select(*names)), "passages")
    start = F.struct("key", "p")
    firsts = singles.groupBy("w1", "w2").agg(F.min(start).alias("first"), F.count(F.lit(1)).alias("n"))
    by_passage = singles.join(firsts.where("n > 1"), ["w1", "w2"]).where(start > F.col("first")).select(
        "key", F.col("p").alias("lo"), F.col("p").alias("hi"))
    found = by_stretch.unionByName(by_block).unionByName(by_passage)
    starts = stored(found.groupBy(F.col("key").alias("_key")).agg(
        F.collect_list(F.struct("lo", "hi")).alias("starts")), "starts")
    discard(stretches, judged, blocks, parts, singles)
    return starts


def covered(size: int, starts: list[tuple[int, int]], passage: int) -> np.ndarray:
    """Mask of the bytes that passages starting in the given ranges cover."""
    steps = np.zeros(size + 1, dtype=np.int32)
    for lo, hi in starts:
        steps[lo] += 1
        steps[hi + passage] -= 1
    return np.cumsum(steps[:-1]) > 0


def _with_starts(docs, id_col, text_col, passage):
    ship(docs.sparkSession)
    texts = _numbered(docs, id_col, text_col)
    starts = repeated_starts(texts, passage)
    return texts.join(starts, "_key", "left").select("_id", "_text", "starts")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE
) -> DataFrame:
    """Remove every byte covered by a passage that also starts earlier.

    One row per input row: id, ``n_bytes``, ``n_removed``, ``spans`` (start and
    end of the maximal removed runs, in bytes) and ``kept`` (the other bytes).
    Earlier means in a row with a smaller id, or in the same text before; NULL
    ids come first, and rows that share an id go by text. NULL text is empty.
    Passages are judged on the input and never cross texts. No rows in, no
    rows out.
    """
    joined = _with_starts(docs, id_col, text_col, passage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                yield _cut_rows(part, passage, id_col)

    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, "
             "spans array<struct<start:bigint,end:bigint>>, kept binary")


def _cut_rows(batch: pa.RecordBatch, passage: int, id_col: str) -> pa.RecordBatch:
    sizes, removed, spans, kept = [], [], [], []
    for text, starts in zip(batch.column(1), batch.column(2)):
        data = _bytes_of(text.as_py())
        mask = covered(len(data), [(r["lo"], r["hi"]) for r in starts.as_py() or ()], passage)
        edges = np.flatnonzero(np.diff(np.r_[False, mask, False]))
        sizes.append(len(data))
        removed.append(int(mask.sum()))
        spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
        kept.append(data[~mask].tobytes())
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
         pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())],
        [id_col, "n_bytes", "n_removed", "spans", "kept"])


def removal_digests(cut: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Sizes and the digest of what ``remove_repeats`` keeps."""
    return cut.select(
        id_col, "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
