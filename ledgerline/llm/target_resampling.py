"""Importance resampling towards a target: hashed n-gram odds per document and a keyed Gumbel draw.

Separators collapse to single spaces; an overlapped regular expression with
look-arounds at the word borders then matches every n-gram where it stands, and
its bytes are counted by CRC. Every text is scanned once: its buckets are
stored and serve the corpus counts and, once these are known, the weights.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import discard, ship, stored, whole_text
from ledgerline.operators import ordered

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: ASCII letters go to lower case, digits and all bytes beyond ASCII stay, the rest separates.
_FOLDED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_SPACES = regex.compile(rb"  +")


def collapsed(text: bytes) -> bytes:
    """Lower-case words with one space between them."""
    return _SPACES.sub(b" ", text.translate(_FOLDED)).strip(b" ")


def ngram_patterns(longest: int) -> list[regex.Pattern]:
    """One pattern per n-gram length; matches begin and end at word borders and may overlap."""
    more = [b"", *[rb"(?: [^ ]+){%d}" % n for n in range(1, longest)]]
    return [regex.compile(rb"(?<![^ ])[^ ]+" + words + rb"(?![^ ])") for words in more]


def feature_buckets(line: bytes, patterns: list[regex.Pattern], buckets: int = BUCKETS) -> list[int]:
    """Bucket of each n-gram of a collapsed text, repeats included."""
    crc = zlib.crc32
    return [crc(match.group()) % buckets for p in patterns for match in p.finditer(line, overlapped=True)]


def scan_features(
    docs: DataFrame, id_col: str | None = None, text_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS,
) -> DataFrame:
    """Per row: ``_id`` (if a column is named), ``_words`` and ``_buckets`` of the whole text."""
    ship(docs.sparkSession)
    patterns = ngram_patterns(longest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, found, ends = [], [np.empty(0, np.int32)], [0]
            for text in batch.column(1).cast(pa.binary()):
                line = collapsed(text.as_py())
                own = feature_buckets(line, patterns, buckets)
                words.append(line.count(b" ") + 1 if line else 0)
                found.append(np.array(own, np.int32))
                ends.append(ends[-1] + len(own))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), lists], ["_id", "_words", "_buckets"])

    key = F.col(id_col) if id_col else F.lit(None).cast("bigint")
    kind = docs.schema[id_col].dataType.simpleString() if id_col else "bigint"
    return docs.select(key.alias("_id"), whole_text(text_col)).mapInArrow(
        run, f"_id {kind}, _words bigint, _buckets array<int>")


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows: each task adds up its own, then one row per bucket is left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["bucket", "n"])

    parts = features.select("_buckets").mapInArrow(run, "bucket int, n bigint")
    table = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most one row per bucket
    counts = np.zeros(buckets, np.int64)
    counts[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log odds of each bucket, target against source, one added to each count."""
    buckets = len(source)
    all_source, all_target = int(source.sum()) + buckets, int(target.sum()) + buckets
    return np.array([
        math.floor(1000 * math.log((t + 1) * all_source / ((s + 1) * all_target)))
        for s, t in zip(source.tolist(), target.tolist())
    ], np.int64)


def gumbel_noise(key: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel number, floored, from the first 32 bits of SHA-256 of ``seed:key``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
    longest: int = LONGEST, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """Weights of all documents, and ranks of those drawn to look like the target texts.

    One row per input row: id, ``n_features``, ``weight`` (floored mean gain of
    the features; 0 without any), ``score`` (weight plus keyed Gumbel noise) and
    ``rank``. Of the N rows with at least ``least_words`` words the
    ``percent * N // 100`` highest scores get ranks from 1, ties to the smaller
    id; all others have a NULL rank. NULL text is empty; a NULL id draws the
    noise of the empty key and comes last among ties; repeated rows repeat,
    each with a rank of its own; an empty target makes every feature's gain
    fall with its own count alone; no rows in, no rows out; columns beyond id and text are
    not read. Ranks come from score counts and a range partitioning of the
    drawn rows, so no task holds them all.
    """
    features = stored(scan_features(docs, id_col, text_col, longest, buckets), "ngram-buckets")
    wanted = scan_features(target, None, target_col, longest, buckets)
    gains = bucket_gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends = np.cumsum(np.concatenate([[0], lists.value_lengths().to_numpy()]))
            sums = np.concatenate([[0], np.cumsum(gains[lists.flatten().to_numpy()])])
            count = np.diff(ends)
            weight = (sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(count, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(count), pa.array(weight)],
                ["_id", "_words", "n_features", "weight"])

    kind = features.schema["_id"].dataType.simpleString()
    scored = stored(
        features.mapInArrow(weigh, f"_id {kind}, _words bigint, n_features bigint, weight bigint")
        .withColumn("score", F.col("weight") + gumbel_noise(F.col("_id"), seed)), "importance")
    discard(features)
    able = F.col("_words") >= least_words
    drawn = F.floor(scored.agg(F.count_if(able)).scalar() * percent / 100)
    placed = ordered.row_numbers(
        scored, [(~able).asc(), F.desc("score"), F.col("_id").asc_nulls_last()], "rank")
    return placed.select(
        F.col("_id").alias(id_col), "n_features", "weight", "score",
        F.when(able & (F.col("rank") <= drawn), F.col("rank")).alias("rank"))
