"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import stored, whole_text

#: Hashed with the length to decide which rows need their full hash.
PREFIX_CHARACTERS = 256
#: Bits of the fixed-size set of surviving (length, prefix) keys: 2 MB, whatever the input.
#: A crowded set only means that more rows than needed get a full hash.
KEY_BITS = 1 << 24


def _key_bit(length: Column, prefix: Column) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(KEY_BITS)) + 1


def _survivors(profile: DataFrame) -> DataFrame:
    """Bitmaps of the (length, prefix hash) keys that more than one row has."""
    lengths = profile.groupBy("_len").agg(F.sum("_n").alias("_rows")).where("_rows > 1")
    repeated = profile.join(lengths, "_len", "left_semi").where("_n > 1")
    bits = repeated.select(_key_bit(F.col("_len"), F.col("_prefix")).alias("_bit"))
    return bits.groupBy(F.bitmap_bucket_number("_bit").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bitmap")
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[Column] = ()
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept`` and the ``carry`` columns.

    Texts are equal when their characters are; NULL equals the empty text. The
    largest id of a group stays. NULL ids stay only in groups that have no
    other; rows that share an id are all kept or all dropped. No rows in, no
    rows out.

    Rows are counted by length and prefix hash in one narrow pass. Lengths seen
    once drop out, then prefixes seen once; a row whose key survives gets a
    full hash. What one group holds is never gathered: copies combine before
    the shuffle, and the join back can be split by AQE.
    """
    text = whole_text(text_col)
    length, prefix = F.octet_length(text), F.xxhash64(F.substring(text, 1, PREFIX_CHARACTERS))
    profile = stored(
        docs.select(length.alias("_len"), prefix.alias("_prefix"))
        .groupBy("_len", "_prefix").agg(F.count(F.lit(1)).alias("_n")),
        "exact-keys",
    )
    names = [f"_carry{i}" for i in range(len(carry))]
    rows = docs.select(
        F.col(id_col).alias("_id"), text.alias("_text"), length.alias("_len"),
        _key_bit(length, prefix).alias("_bit"),
        *[column.alias(name) for column, name in zip(carry, names, strict=True)],
    ).withColumn("_bucket", F.bitmap_bucket_number("_bit"))
    byte = F.expr("hex(substring(_bitmap, int(bitmap_bit_position(_bit) div 8) + 1, 1))")
    survives = F.conv(byte, 16, 10).cast("int").bitwiseAND(
        F.expr("shiftleft(1, int(bitmap_bit_position(_bit) % 8))")
    ) != 0
    # Without a surviving key the row is alone; its own key spreads such rows evenly.
    hashed = rows.join(F.broadcast(_survivors(profile)), "_bucket", "left").withColumn(
        "_hash", F.when(survives, F.sha2("_text", 256))
    )
    groups = stored(
        hashed.where(F.col("_hash").isNotNull()).groupBy("_len", "_hash").agg(
            F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_size")).where("_size > 1"),
        "exact-groups",
    )
    alone = F.concat(F.lit("alone "), F.xxhash64("_id", "_bit").cast("string"))
    joined = hashed.withColumn("_hash", F.coalesce("_hash", alone)).drop("_text").join(
        groups, ["_len", "_hash"], "left"
    )
    keep = F.coalesce("_keep", "_id")
    return joined.select(
        F.col("_id").alias(id_col), keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        *[F.col(name).alias(_name_of(docs, column)) for column, name in zip(carry, names, strict=True)],
    )


def _name_of(docs: DataFrame, column: Column) -> str:
    return docs.select(column).columns[0]
