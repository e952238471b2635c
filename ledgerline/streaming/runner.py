"""Sinks and bounded runs of streaming queries.

Checkpoints and output folders are paths the caller takes from the shared
folder, so a restarted driver or a lost executor resumes from them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ledgerline.operators.layout import cached
from ledgerline.sources.files import stream_transactions, write_transactions


def to_console(stream: DataFrame, checkpoint: str, mode: str = "complete", rows: int = 30) -> DataStreamWriter:
    return (
        stream.writeStream.outputMode(mode).format("console")
        .option("truncate", False).option("numRows", rows)
        .option("checkpointLocation", checkpoint)
    )


def to_memory(stream: DataFrame, name: str, mode: str = "complete", checkpoint: str | None = None) -> DataStreamWriter:
    """Result kept on the driver under a table name: for looking at small results."""
    writer = stream.writeStream.outputMode(mode).format("memory").queryName(name)
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer


def to_files(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Closed windows appended to Parquet exactly once."""
    return (
        stream.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
    )


def to_versions(stream: DataFrame, path: str, checkpoint: str, mode: str) -> DataStreamWriter:
    """Every micro-batch's output in a folder of its own, ``batch_id=<n>``.

    A repeated batch overwrites its own folder, so a retry leaves no doubles.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.outputMode(mode).foreachBatch(save)
        .option("checkpointLocation", checkpoint)
    )


def to_sinks(
    stream: DataFrame, sinks: Mapping[str, Callable[[DataFrame, int], None]], committed: str, checkpoint: str,
    mode: str = "append",
) -> DataStreamWriter:
    """One stream to several sinks, each micro-batch computed once.

    A sink is a function of (batch, batch id) that replaces what it may have
    written for that id before. When all sinks have a batch, a marker in the
    folder ``committed`` says so; a batch that failed half way is repeated under its id, so
    readers who go by the markers (``read_committed``) find all sinks equal.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        with cached(batch) as held:
            for write in sinks.values():
                write(held, batch_id)
        batch.sparkSession.range(1).select(F.lit(batch_id).cast("long").alias("batch_id")).coalesce(1).write.mode(
            "overwrite").parquet(f"{committed}/marker={batch_id}")

    return stream.writeStream.outputMode(mode).foreachBatch(save).option("checkpointLocation", checkpoint)


def parquet_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A folder of its own per batch id, overwritten by a repeated batch."""
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def json_sink(path: str) -> Callable[[DataFrame, int], None]:
    """JSON lines for other systems, laid out the same way."""
    return lambda batch, batch_id: write_transactions(batch, f"{path}/batch_id={batch_id}", mode="overwrite")


def read_committed(
    spark: SparkSession, path: str, committed: str, schema: StructType, kind: str = "parquet"
) -> DataFrame:
    """Rows of one sink whose batch reached every sink, with their ``batch_id``."""
    whole = StructType([*schema.fields, StructField("batch_id", LongType())])
    done = spark.read.schema("batch_id long").parquet(committed)  # one row per batch
    return spark.read.schema(whole).format(kind).load(path).join(F.broadcast(done), "batch_id", "left_semi")


def read_versions(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All folders written by ``to_versions`` with their ``batch_id``."""
    whole = StructType([*schema.fields, StructField("batch_id", LongType())])
    return spark.read.schema(whole).parquet(path)


def last_version(versions: DataFrame) -> DataFrame:
    """The newest complete-mode result; older folders are pruned by the scan."""
    newest = versions.agg(F.max("batch_id").alias("b")).scalar()
    return versions.where(F.col("batch_id") == newest).drop("batch_id")


def newest_per_key(versions: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Update-mode output reduced to the last state of each key."""
    keys = list(keys)
    values = [c for c in versions.columns if c not in (*keys, "batch_id")]
    latest = versions.groupBy(*keys).agg(
        F.max_by(F.struct(*values), "batch_id").alias("latest")
    )
    return latest.select(*keys, "latest.*")


def run_available(writer: DataStreamWriter, timeout: int | None = None) -> StreamingQuery:
    """Process what is there now, then stop; ``timeout`` seconds bound the run if given."""
    query = writer.trigger(availableNow=True).start()
    try:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            raise TimeoutError(f"stream still busy after {timeout} s")
    finally:
        query.stop()
    return query


def run_for(writer: DataStreamWriter, seconds: int | None) -> StreamingQuery:
    """Run for a number of seconds, or until stopped when ``seconds`` is None."""
    query = writer.start()
    try:
        if seconds is None:
            query.awaitTermination()
        else:
            query.awaitTermination(seconds)
    finally:
        query.stop()
    return query


def run_arrivals(
    spark: SparkSession, arrivals: Iterable[DataFrame], incoming: str,
    attach: Callable[[DataFrame], DataStreamWriter],
) -> None:
    """Deliver tables one after the other to a stream that restarts each time.

    Each arrival is written as JSON lines to the watched folder and read by a
    new run of the query from the same checkpoint.
    """
    for arrival in arrivals:
        write_transactions(arrival, incoming)
        run_available(attach(stream_transactions(spark, incoming, files_per_trigger=None)))
