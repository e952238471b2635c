"""One contact per client and span of time: which contacts may take place.

A kept contact restarts the clock, so whether a contact is kept depends on the
whole chain before it. The chain of a client is: the first contact, then
always the first one at least a span later. "First one a span later" is found
for all contacts at once, in slices of time as long as the span: the answer
lies in the next slice or is the first contact of a slice after. The chain is then
walked by pointer doubling, in as many rounds as the longest chain has binary
digits, however long a client's history is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerline.session import fresh_dir
from ledgerline.sources.files import store

MICROS_PER_DAY = 86_400_000_000


def next_allowed(moments: DataFrame, span: int) -> DataFrame:
    """Distinct ``(client, t)`` with ``next``, the client's first moment at ``t + span`` or after.

    A slice of a client has at most as many rows as distinct moments in it, and
    a running minimum over them.
    """
    own = moments.select("client", "t", F.floor(F.col("t") / span).alias("slice"))
    later = own.select("client", F.col("t").alias("origin"), (F.col("t") + span).alias("t"), (F.col("slice") + 1).alias("slice"))
    both = own.withColumn("origin", F.lit(None).cast("bigint")).unionByName(later)
    from_there = Window.partitionBy("client", "slice").orderBy(F.desc("t")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    moment = F.when(F.col("origin").isNull(), F.col("t"))
    found = both.withColumn("found", F.min(moment).over(from_there)).where("origin is not null").select(
        "client", F.col("origin").alias("t"), (F.col("slice") - 1).alias("slice"), "found")

    # One row per client and slice in use.
    order = Window.partitionBy("client").orderBy("slice")
    firsts = own.groupBy("client", "slice").agg(F.min("t").alias("first")).select(
        "client", "slice", F.lead("slice").over(order).alias("slice1"),
        F.lead("first").over(order).alias("first1"), F.lead("first", 2).over(order).alias("first2"))
    beyond = F.when(F.col("slice1") == F.col("slice") + 1, F.col("first2")).otherwise(F.col("first1"))
    return found.join(firsts, ["client", "slice"]).select(
        "client", "t", F.coalesce("found", beyond).alias("next"))


def chain_from_first(pointers: DataFrame) -> DataFrame:
    """The ``(client, t)`` reached from each client's first moment by following ``next``.

    After round r the first 2^r links of every chain are known. Every round is stored.
    """
    spark = pointers.sparkSession
    jumps = store(pointers.where("next is not null"), fresh_dir(spark, "jumps"))
    reached = store(pointers.groupBy("client").agg(F.min("t").alias("t")), fresh_dir(spark, "reached"))
    while True:
        ahead = store(
            reached.join(jumps, ["client", "t"]).select("client", F.col("next").alias("t")), fresh_dir(spark, "ahead"))
        if ahead.isEmpty():
            return reached
        reached = reached.unionByName(ahead)
        second = jumps.select("client", F.col("t").alias("next"), F.col("next").alias("after"))
        jumps = store(
            jumps.join(second, ["client", "next"]).select("client", "t", F.col("after").alias("next")),
            fresh_dir(spark, "jumps"))


def rate_limit(df: DataFrame, client: str, at: str, key: str, days: int = 90) -> DataFrame:
    """Add ``allowed``: whether the contact takes place when each client is contacted once in ``days`` days.

    A client's first contact is allowed, and then the first one at least
    ``days`` days after the last allowed one. Of contacts at the same moment the one with
    the smallest ``key`` goes first. ``key`` should be unique; rows that repeat
    client, moment and key share their fate. Rows without a client or a time get NULL. An
    empty table stays empty. ``at`` is a date or a timestamp, whose
    time of day counts.
    """
    spark = df.sparkSession
    span = days * MICROS_PER_DAY
    moment = F.unix_micros(F.col(f"`{at}`").cast("timestamp"))
    known = df.select(F.col(f"`{client}`").alias("client"), moment.alias("t"), F.col(f"`{key}`").alias("k")).where(
        "client is not null and t is not null")
    # Contacts of one moment meet here: a hot client shrinks to its distinct moments before the first window.
    moments = store(known.groupBy("client", "t").agg(F.min("k").alias("k")), fresh_dir(spark, "moments"))
    pointers = store(next_allowed(moments, span), fresh_dir(spark, "next-allowed"))
    kept = chain_from_first(pointers).join(moments, ["client", "t"]).select(
        F.col("client").alias("_client"), F.col("t").alias("_t"), F.col("k").alias("_k"), F.lit(True).alias("_kept"))
    rows = df.withColumn("_moment", moment)
    same = (rows[client] == kept["_client"]) & (rows["_moment"] == kept["_t"]) & rows[key].eqNullSafe(kept["_k"])
    allowed = F.when(
        F.col(f"`{client}`").isNotNull() & F.col("_moment").isNotNull(), F.coalesce("_kept", F.lit(False)))
    return rows.join(kept, same, "left").select(*[rows[c] for c in df.columns], allowed.alias("allowed"))
