"""Joins of a large table with a lookup table, by declared strategy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 2**20


def is_small(
    lookup: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether a lookup may be broadcast: one distributed count of its rows and bytes."""
    texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in lookup.columns]
    row_bytes = sum(texts, F.lit(8 * len(texts)))
    size = lookup.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes")
    ).first()
    return size["n"] <= max_rows and size["bytes"] <= max_bytes


def lookup_join(fact: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """Inner join by Catalyst's choice; unmatched and NULL keys drop out."""
    return fact.join(lookup, on, "inner")


def broadcast_join(
    fact: DataFrame, lookup: DataFrame, on: str, max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Broadcast a lookup whose size was checked; a larger one is refused."""
    if not is_small(lookup, max_rows):
        raise ValueError(f"lookup exceeds {max_rows} rows or {BROADCAST_BYTES} bytes; use shuffle_join")
    return fact.join(F.broadcast(lookup), on, "inner")


def shuffle_join(
    fact: DataFrame, lookup: DataFrame, on: str, salt_on: Sequence[str], salts: int = 16
) -> DataFrame:
    """Sort-merge join with every key spread over ``salts`` partitions.

    A lookup key such as a job title may own a third of the fact table; the
    salt (a hash of ``salt_on``, ideally the row key) divides it evenly and
    each lookup row is repeated once per salt. AQE's skew join splits further
    whatever is still oversized.
    """
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), [on, "_salt"], "inner").drop("_salt")
